"""Joins of rows to their groups where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group with this share of all rows is joined by broadcast: there are at most as many.
SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` inner-joined to the one row that ``groups`` has for their (non-null) ``keys``.

    ``size`` is the groups' row count. Groups with a ``SHARE``-th of all rows or
    more are at most ``SHARE`` in number and joined by broadcast; in the
    shuffled join of the others no key is hot. Both inputs are read twice:
    they should be written tables.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0]
    is_large = F.col(size) * SHARE >= max(total, SHARE)
    large = groups.where(is_large)
    of_large = rows.join(F.broadcast(large), keys)
    rest = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti")
    return of_large.unionByName(rest.join(groups.where(~is_large), keys))
