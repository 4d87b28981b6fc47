"""The most frequent keys of a table of counts, for a broadcast of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(counts: DataFrame, key: str, most: int) -> pa.Table:
    """Rows of ``counts`` (a written table with a count ``c``) with the largest counts, best first.

    All rows from some count on, at most ``most`` of them. The limit comes from
    a histogram of the counts in eighths of a power of two, a few hundred rows,
    so no task merges the best rows of all others.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for row in sorted(bins, key=lambda r: -r["bin"]):
        total += row["n"]
        if total > most:
            break
        least = row["bin"]
    wanted = F.lit(False) if least is None else step >= least
    table = counts.where(wanted).toArrow()
    order = np.lexsort((table[key].to_numpy(), -table["c"].to_numpy()))
    return table.take(pa.array(order))
