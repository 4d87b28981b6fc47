"""Operators on a table's columns, and the union of aligned tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.names import free_name, quoted


def project(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the named columns; a missing one raises."""
    return df.select(*(F.col(quoted(c)) for c in columns))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn its spaces into underscores.

    Two names that become one raise: later references would be ambiguous.
    """
    names = [c.lower().replace(" ", "_") for c in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns collide after normalising: {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old -> new. Unlike ``withColumnsRenamed``, a missing column raises."""
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"no such columns to rename: {missing}")
    return df.withColumnsRenamed(dict(names))


def add_literal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Tag every row with the same value, such as the year of a snapshot."""
    return df.withColumn(column, F.lit(value))


# Whole numbers from narrow to wide, and the decimal digits that hold each.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of ``source`` has a place in ``target``, in the order of SQL's types.

    Whole numbers widen to longer ones, to decimals with enough digits and to
    doubles (a bigint beyond 2**53 is rounded); floats to doubles; decimals to
    those with as many digits on both sides of the point; dates to timestamps
    without a zone; an untyped null to all. Nothing else does: strings are no
    target, as a text of a number is another value.
    """
    if source == target or isinstance(source, T.NullType):
        return True
    if source in _WHOLE:
        if target in _WHOLE:
            return _WHOLE[source] <= _WHOLE[target]
        if isinstance(target, T.DecimalType):
            return target.precision - target.scale >= _WHOLE[source]
        return isinstance(target, T.DoubleType)
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        digits = source.precision - source.scale <= target.precision - target.scale
        return digits and source.scale <= target.scale
    if isinstance(source, T.FloatType):
        return isinstance(target, T.DoubleType)
    return isinstance(source, T.DateType) and isinstance(target, T.TimestampNTZType)


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _present(df: DataFrame, schema: T.StructType, what: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what} has no columns {missing}")


def conform(df: DataFrame, schema: T.StructType | str, what: str = "the table") -> DataFrame:
    """The columns of ``schema``, in its order and types; others are left out.

    A missing column raises, and so does one whose type does not widen to the
    declared one (``widens``): at once, before any row is read.
    """
    schema = _as_schema(schema)
    _present(df, schema, what)
    clashes = [
        f"{f.name}: {df.schema[f.name].dataType.simpleString()} is no {f.dataType.simpleString()}"
        for f in schema.fields
        if not widens(df.schema[f.name].dataType, f.dataType)
    ]
    if clashes:
        raise TypeError(f"{what} does not fit the schema: {', '.join(clashes)}")
    return df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform_or_reject(df: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects): ``df`` in the columns and types of ``schema``, and the rows that do not fit.

    Columns whose types do not widen are tried value by value. A row with a
    value that cannot be had in the declared type, or that comes out as another
    when cast back (a fraction as a whole number), is in ``rejects``, with all
    its own columns and ``reason``, the names of such columns. NULL fits any
    type. A missing column raises.
    """
    schema = _as_schema(schema)
    _present(df, schema, "the table")
    wrong = []
    for f in schema.fields:
        own, source = F.col(quoted(f.name)), df.schema[f.name].dataType
        if not widens(source, f.dataType):
            # Of texts, which can be written in several ways, only the parse counts.
            back = own if isinstance(source, T.StringType) else own.try_cast(f.dataType).try_cast(source)
            lost = own.try_cast(f.dataType).isNull() | ~back.eqNullSafe(own)
            wrong.append(F.when(own.isNotNull() & lost, F.lit(f.name)))
    reason = free_name(df.columns, "reason")
    judged = df.withColumn(reason, F.concat_ws(", ", *wrong) if wrong else F.lit(""))
    clean = judged.where(F.col(reason) == "").select(
        *[F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    return clean, judged.where(F.col(reason) != "")


def _common(left: DataFrame, right: DataFrame) -> T.StructType:
    """The types to which both sides' columns widen; a clash raises."""
    fields, clashes = [], []
    for f in left.schema.fields:
        a, b = f.dataType, right.schema[f.name].dataType
        wide = b if widens(a, b) else a if widens(b, a) else None
        if wide is None:
            clashes.append(f"{f.name}: {a.simpleString()} and {b.simpleString()}")
        fields.append(T.StructField(f.name, wide or a))
    if clashes:
        raise TypeError(f"the types of both tables do not meet: {', '.join(clashes)}")
    return T.StructType(fields)


def align_and_union(
    snapshot: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    *,
    cohort: tuple[str, object] | None = None,
    snapshot_names: Mapping[str, str] | None = None,
    history_names: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All rows of both tables, with ``columns`` matched by name.

    ``cohort`` is the (column, value) the snapshot lacks; the ``*_names`` maps
    rename each side's own columns first. The types of the result are those of
    ``schema``, which has ``columns``, or else the wider one of both sides. A
    type that does not widen to it raises at once and names the column.
    """
    if cohort is not None:
        snapshot = add_literal(snapshot, *cohort)
    left = project(rename(snapshot, snapshot_names or {}), *columns)
    right = project(rename(history, history_names or {}), *columns)
    target = _common(left, right) if schema is None else _as_schema(schema)
    if sorted(target.names) != sorted(columns):
        raise ValueError(f"the schema must have the columns {list(columns)}")
    left, right = conform(left, target, "the snapshot"), conform(right, target, "the history")
    return left.unionByName(right).select(*[F.col(quoted(c)) for c in columns])
