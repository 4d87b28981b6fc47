"""First-match-wins classification of an entity by its region and its name.

The rules are data. ``classify`` compiles them to one CASE expression, which
Catalyst optimises and whole-stage codegen runs without a Python worker.
``register_classifier`` makes the same a function for SQL text, and
``classify_udf`` a vectorised UDF, for sessions that take only those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from podium.functions.names import quoted


@dataclass(frozen=True)
class Rule:
    """``label`` if the region contains ``contains`` and / or the entity is in ``members``.

    With both tests given, ``need`` says whether "all" of them or "any" of them
    must hold. Tests are case-sensitive; members match exactly.
    """

    label: str
    contains: str | None = None
    members: tuple[str, ...] = ()
    need: str = "all"

    def __post_init__(self) -> None:
        if self.contains is None and not self.members:
            raise ValueError(f"rule {self.label!r} tests nothing")
        if self.need not in ("all", "any"):
            raise ValueError(f"need must be 'all' or 'any', not {self.need!r}")

    def condition(self, region: Column, entity: Column) -> Column:
        tests = []
        if self.contains is not None:
            tests.append(F.coalesce(region, F.lit("")).contains(self.contains))
        if self.members:
            tests.append(F.coalesce(entity.isin(*self.members), F.lit(False)))
        if len(tests) == 1:
            return tests[0]
        return tests[0] & tests[1] if self.need == "all" else tests[0] | tests[1]


def classify(
    rules: Sequence[Rule], region: Column, entity: Column, default: str | None = "Other"
) -> Column:
    """The label of the first rule that holds, else ``default`` (which may be None)."""
    if not rules:
        raise ValueError("no rules")
    first, *rest = [(rule.condition(region, entity), F.lit(rule.label)) for rule in rules]
    chain = F.when(*first)
    for branch in rest:
        chain = chain.when(*branch)
    return chain.otherwise(F.lit(default).cast("string"))


def classify_udf(rules: Sequence[Rule], default: str | None = "Other"):
    """The same classifier as an Arrow-batched pandas UDF ``(region, entity) -> string``.

    Register it with ``spark.udf.register(name, classify_udf(rules))``.
    """
    # Plain tuples only: the closure is pickled whole, so executors need no
    # installed copy of this package.
    plain = [(r.label, r.contains, frozenset(r.members), r.need) for r in rules]

    @F.pandas_udf("string")
    def label(region: pd.Series, entity: pd.Series) -> pd.Series:
        out = pd.Series([default] * len(region), dtype=object)
        open_rows = pd.Series(True, index=out.index)
        text = region.fillna("").astype(str)
        for name, part, members, need in plain:
            in_text = text.str.contains(part, regex=False) if part is not None else None
            in_list = entity.isin(members) if members else None
            if in_text is None:
                hit = in_list
            elif in_list is None:
                hit = in_text
            else:
                hit = (in_text & in_list) if need == "all" else (in_text | in_list)
            hit = hit & open_rows
            out[hit] = name
            open_rows &= ~hit
        return out

    return label


def sql_text(value: str | None) -> str:
    """``value`` as a literal of SQL text: all but plain letters and digits by their code points."""
    if value is None:
        return "CAST(NULL AS STRING)"
    plain = (c if c.isascii() and (c.isalnum() or c == " ") else f"\\U{ord(c):08X}" for c in value)
    return "'" + "".join(plain) + "'"


def classify_sql(rules: Sequence[Rule], region: str, entity: str, default: str | None = "Other") -> str:
    """``classify`` as SQL text over two expressions of SQL."""
    if not rules:
        raise ValueError("no rules")
    branches = []
    for rule in rules:
        tests = []
        if rule.contains is not None:
            tests.append(f"contains(coalesce({region}, ''), {sql_text(rule.contains)})")
        if rule.members:
            tests.append(f"coalesce({entity} IN ({', '.join(map(sql_text, rule.members))}), false)")
        both = (" AND " if rule.need == "all" else " OR ").join(tests)
        branches.append(f"WHEN {both} THEN {sql_text(rule.label)}")
    return f"CASE {' '.join(branches)} ELSE {sql_text(default)} END"


def register_classifier(
    spark: SparkSession, name: str, rules: Sequence[Rule], default: str | None = "Other"
) -> None:
    """Register ``name(region, entity)`` for SQL text, as a function of the session.

    Its body is SQL too, so Catalyst puts it in place of the call: no Python,
    and filters on it can be pushed and folded. A function of that name is replaced.
    """
    body = classify_sql(rules, "region", "entity", default)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}(region STRING, entity STRING)"
        f" RETURNS STRING RETURN {body}"
    )
