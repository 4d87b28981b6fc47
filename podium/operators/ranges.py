"""Ranges of about equal size over the values of columns of any orderable type.

A sample gives the splitters: every so-many-th of its sorted keys. A key that
is chosen more than once fills a range or more by itself; it gets a range of
its own, whose rows need no order among themselves and are dealt to as many
parts. The range of a row is found by a binary search in a constant array, so
it depends on the row's key alone, and keys and ranges have the same order:
results built on them are exact, whatever the sample was.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.names import free_name, quoted

# Sampled keys for each range, and most ranges: so many times as many keys, 64 bytes or so
# each, are sorted in one task, and two splitters a range are part of the plan.
SAMPLED = 20
MOST_RANGES = 20_000
# Characters of a string key that count for the splitters.
_PREFIX = 256
# No row's key has so large a number of parts: it comes after an equal splitter.
_LAST = (1 << 31) - 1


@dataclass(frozen=True)
class Ranges:
    """``count`` ranges over ``columns`` in ascending order (null first, NaN last).

    ``parts[i]`` is the number of parts that range ``i`` is dealt to: 1, or more
    for the range of a single key.
    """

    columns: tuple[str, ...]
    splitters: Column | None
    parts: tuple[int, ...]

    @property
    def count(self) -> int:
        return len(self.parts)

    @property
    def is_single(self) -> tuple[bool, ...]:
        return tuple(n > 1 for n in self.parts)

    def _own_key(self) -> Column:
        return _key([F.col(quoted(c)) for c in self.columns], F.lit(0), F.lit(_LAST))

    def find(self) -> Column:
        """The range of a row: how many splitters its key has reached, by halving steps."""
        if self.splitters is None:
            return F.lit(0)
        key, splitters = self._own_key(), self.splitters
        steps = _integers(1 << k for k in reversed(range((self.count - 1).bit_length())))

        def go_on(reached: Column, step: Column) -> Column:
            # Behind the last splitter there is null, which no key reaches.
            return F.when(key >= F.get(splitters, reached + step - 1), reached + step).otherwise(reached)

        return F.aggregate(steps, F.lit(0), go_on)

    def reaches(self, number: int) -> Column:
        """Whether a row lies in range ``number`` or behind it; a comparison with one constant."""
        if number <= 0:
            return F.lit(True)
        if number >= self.count:
            return F.lit(False)
        return self._own_key() >= F.get(self.splitters, F.lit(number - 1))

    def deal(
        self, df: DataFrame, range_name: str, part_name: str, task_name: str | None = None, tasks: int = 0
    ) -> DataFrame:
        """``df`` with its ``range_name``, and in one exchange dealt to partitions numbered ``part_name``.

        A partition holds a range, or a part of a range of a single key; these
        are dealt by a hash of the whole row and its present partition. A
        window by ``part_name`` needs no further exchange. With a ``task_name``, there
        are ``tasks`` partitions at most, numbered so; neighbouring parts share one
        where there are more parts, and a window goes by both names.
        """
        df = df.withColumn(range_name, self.find())
        first = _integers(itertools.accumulate(self.parts[:-1], initial=0))
        place = F.get(first, F.col(quoted(range_name)))
        if max(self.parts) > 1:
            # Types without a hash (maps) take no part in it.
            hashed = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
            spread = F.pmod(
                F.xxhash64(*hashed, F.spark_partition_id()), F.get(_integers(self.parts), F.col(quoted(range_name)))
            )
            place = place + spread.cast("int")
        n_parts = sum(self.parts)
        dealt = df.withColumn(part_name, place)
        if task_name is None:
            return dealt.repartitionById(n_parts, F.col(quoted(part_name)))
        tasks = max(1, min(tasks, n_parts))
        task = F.floor(F.col(quoted(part_name)).cast("bigint") * tasks / n_parts).cast("int")
        return dealt.withColumn(task_name, task).repartitionById(tasks, F.col(quoted(task_name)))


def _integers(numbers: Iterable[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")


def _key(columns: Sequence[Column], after: Column, parts: Column) -> Column:
    fields = [c.alias(f"c{i}") for i, c in enumerate(columns)]
    return F.struct(*fields, after.alias("after"), parts.alias("parts"))


# Splitters must come back from text as they were, to the microsecond.
_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def splitter_value(value: Column, dtype: T.DataType) -> Column:
    """What a splitter keeps of ``value``: of a string, its first characters."""
    return F.substring(value, 1, _PREFIX) if isinstance(dtype, T.StringType) else value


def range_count(df: DataFrame, n_rows: int, rows_per_range: int, least_rows: int = 50_000) -> int:
    """Ranges of ``rows_per_range`` rows, or smaller ones, of ``least_rows`` at least, to use all tasks."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(math.ceil(n_rows / rows_per_range), min(tasks, n_rows // least_rows))
    return max(1, min(wanted, MOST_RANGES))


def task_count(df: DataFrame, n_rows: int, rows_per_task: int = 5_000_000) -> int:
    """Tasks for ``n_rows`` rows: as many as the session shuffles to, more above ``rows_per_task`` rows each."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / rows_per_task))


def value_ranges(df: DataFrame, columns: Sequence[str], n_rows: int, ranges: int) -> Ranges:
    """Cut the ``n_rows`` rows of ``df`` to about ``ranges`` ranges of their ``columns``. An action.

    Any type works that Spark can order, but intervals. Reads the columns of
    ``df`` once, for the sample; a small table is sampled whole.
    """
    columns = tuple(columns)
    if ranges <= 1 or n_rows <= 0:
        return Ranges(columns, None, (1,))
    share = SAMPLED * ranges / n_rows
    values = [splitter_value(F.col(quoted(c)), df.schema[c].dataType) for c in columns]
    keys = df.select(_key(values, F.lit(0), F.lit(1)).alias("k"))
    if share < 1:
        keys = keys.sample(fraction=share, seed=17)
    step = F.lit(SAMPLED) if share < 1 else F.greatest(F.floor(F.size("all") / ranges).cast("int"), F.lit(1))
    in_order = keys.agg(F.sort_array(F.collect_list("k")).alias("all")).withColumn("step", step)
    chosen = in_order.select(F.filter("all", lambda _, i: (i + 1) % F.col("step") == 0).alias("s"))
    text = chosen.select(F.to_json("s", _FORMATS).alias("text")).head()["text"]
    parts, splitters = [1], []
    for key, same in itertools.groupby(_elements(text)):
        n = sum(1 for _ in same)
        body = key.removesuffix(_END.format(0, 1))
        splitters.append(body + _END.format(0, n))
        parts.append(n)
        if n > 1:
            splitters.append(body + _END.format(1, 1))
            parts.append(1)
    if not splitters:
        return Ranges(columns, None, (1,))
    # Sorted anew: a type that loses digits in the text may lose its order too.
    array = F.from_json(F.lit("[" + ",".join(splitters) + "]"), chosen.schema["s"].dataType, _FORMATS)
    return Ranges(columns, F.sort_array(array), tuple(parts))


# The last fields of a splitter's text.
_END = '"after":{},"parts":{}}}'


def _elements(text: str) -> Iterator[str]:
    """The text of each element of a JSON array."""
    decoder, at = json.JSONDecoder(), 1
    while text[at] != "]":
        _, end = decoder.raw_decode(text, at)
        yield text[at:end]
        at = end + (text[end] == ",")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """A free name for each of ``names``, different from each other."""
    taken = list(df.columns)
    for name in names:
        taken.append(free_name(taken, name))
    return taken[-len(names) :]
