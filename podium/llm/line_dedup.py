"""Line deduplication with a suffix array over line ids.

Every line gets a rank, the number of lines that sort before it. Prefix
doubling ranks runs of 1, 2, 4, ... lines: the rank of a run of twice the
length is that of the pair of ranks of its halves, found by a range sort and
prefix sums. Runs that occur once are discarded, so each round has fewer rows.
The runs that share a rank are an interval of the suffix array whose common
prefix is as long as the run; two overlapping runs of a power of two give the
interval of any length between. In each interval the first occurrence stays.

A repeated run of ``min_words`` words or more is the union of its smallest runs
of so many words that start, or end, at some line of it. So the ranks are only
needed up to that length, and the maximal repeated runs are the unions of the
repeated smallest runs: deeper sorting could not change what is deleted.

Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.skew import join_groups
from podium.operators import free_name
from podium.sources import materialize

MIN_WORDS = 16
_SPACE = r"[\x20\x09-\x0D]"
_DOC = ["no_id", "doc_id", "doc"]


def _doc_key() -> Column:
    """16 bytes for a document; rows with equal id and text are one document."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(doc_id, F.lit("|"), F.md5(F.coalesce("text", F.lit(""))))))


def _text_lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def _lines(docs: DataFrame) -> DataFrame:
    """One row for each line with a word: document, place among such lines (``pos``)
    and among all (``at``), digest of the line without outer white space, words."""
    numbered = F.filter(
        F.transform(
            _text_lines(),
            lambda line, i: F.struct(
                i.alias("at"), F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("w"), line.alias("line")
            ),
        ),
        lambda x: x["w"] > 0,
    )
    return docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        "doc_id",
        _doc_key().alias("doc"),
        F.posexplode(numbered).alias("pos", "l"),
    ).select(
        *_DOC,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("l.at").alias("at"),
        F.col("l.w").cast("bigint").alias("w"),
        F.unhex(F.md5(F.btrim(F.col("l.line"), F.lit(" \t\r\x0b\x0c")))).alias("digest"),
    )


def _ranked(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` whose key occurs more than once, with its rank: the number of
    such rows that sort before it. The key is replaced by the rank.

    Keys are counted before they are exchanged, sorted by range, and numbered by
    prefix sums: first over the ranges' totals, then within each range.
    """
    counts = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    dealt = counts.repartitionByRange(*key).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, f"{name}-ranges")
    totals = dealt.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        dealt.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(bases, "part")
        .select(*key, "n", (F.col("base") + F.col("inside")).alias("rank"))
    )
    ranks = materialize(ranks, f"{name}-ranks")
    return materialize(join_groups(rows, ranks, key, "n").drop(*key, "n"), name)


def _smallest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(document, s, m): for each line of ``lines`` the smallest run of ``min_words``
    words that starts there, and the smallest that ends there, within stretches
    of neighbouring lines. ``lines`` has the repeated lines only: a run with
    another line in it occurs once."""
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    rows = lines.withColumn("stretch", F.col("pos") - F.row_number().over(in_doc))
    stretch = [*_DOC, "stretch"]
    total = Window.partitionBy(*stretch)
    rows = rows.withColumn("after", F.sum("w").over(total.orderBy("pos")))
    rows = rows.withColumn("before", F.col("after") - F.col("w")).withColumn(
        "all", F.max("after").over(total)
    )
    # Words grow line by line, so a frame of words holds the lines of the run.
    ahead = total.orderBy("before").rangeBetween(Window.currentRow, min_words - 1)
    behind = total.orderBy("after").rangeBetween(-(min_words - 1), Window.currentRow)
    rows = rows.withColumn("m_start", F.count("*").over(ahead)).withColumn(
        "m_end", F.count("*").over(behind)
    )
    starts = rows.where(F.col("all") - F.col("before") >= min_words).select(
        *_DOC, F.col("pos").alias("s"), F.col("m_start").alias("m")
    )
    ends = rows.where(F.col("after") >= min_words).select(
        *_DOC, (F.col("pos") - F.col("m_end") + 1).alias("s"), F.col("m_end").alias("m")
    )
    return starts.unionByName(ends).distinct()


def _same_doc(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the document's 16 bytes and the position."""
    return left.join(right, ["doc", "pos"])


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, at): the lines in a run of ``min_words`` words or more that occurs earlier.

    Earlier is by id (null last), then position. ``doc`` is the document's key.
    """
    lines = materialize(_lines(docs), "lines")
    level = _ranked(lines, ["digest"], "run-1").dropDuplicates(["doc", "pos"])
    level = materialize(level, "level-1")
    places = level.select("doc", "pos", "at")
    runs = materialize(_smallest_runs(level, min_words), "runs")
    # Words of a block, of its first and of its last line.
    level = level.select(
        *_DOC, "pos", "rank", F.col("w").alias("words"), F.col("w").alias("w_first"), F.col("w").alias("w_last")
    )
    longest = runs.agg(F.coalesce(F.max("m"), F.lit(0))).head()[0]
    found, h = [], 1
    while True:
        # Runs of h to 2h - 1 lines: a block of h from the start and one to the end.
        here = runs.where(F.col("m").between(h, 2 * h - 1))
        block = level.select("doc", "pos", "rank")
        first = here.withColumn("pos", F.col("s"))
        first = _same_doc(first, block).withColumnRenamed("rank", "rank_a")
        both = first.withColumn("pos", F.col("s") + F.col("m") - h)
        both = _same_doc(both, block).withColumnRenamed("rank", "rank_b")
        found.append(both.select(*_DOC, "s", "m", "rank_a", "rank_b"))
        h *= 2
        if h > longest:
            break
        next_block = Window.partitionBy("doc").orderBy("pos").rangeBetween(h // 2, h // 2)
        pairs = level
        for column in ("rank", "words", "w_last"):
            pairs = pairs.withColumn(f"{column}_2", F.first(column).over(next_block))
        # A block that has the words without its last, and without its first
        # line, is in no smallest run.
        words = F.col("words") + F.col("words_2")
        pairs = pairs.where("rank_2 is not null").select(
            *_DOC,
            "pos",
            F.col("rank").alias("rank_a"),
            F.col("rank_2").alias("rank_b"),
            words.alias("words"),
            "w_first",
            F.col("w_last_2").alias("w_last"),
        )
        pairs = pairs.where(F.col("words") - F.greatest("w_first", "w_last") < min_words)
        level = _ranked(materialize(pairs, f"pairs-{h}"), ["rank_a", "rank_b"], f"run-{h}")

    every = materialize(reduce(DataFrame.unionByName, found), "ranked-runs")
    key = ["m", "rank_a", "rank_b"]
    own = F.struct("no_id", "doc_id", "doc", "s")
    firsts = every.groupBy(*key).agg(F.min(own).alias("first"), F.count("*").alias("n"))
    firsts = materialize(firsts.where("n > 1"), "first-runs")
    later = join_groups(every, firsts, key, "n").where(
        (F.col("doc") != F.col("first.doc")) | (F.col("s") != F.col("first.s"))
    )
    marked = later.select(
        "doc", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("m") - 1)).alias("pos")
    ).distinct()
    return _same_doc(marked, places).select("doc", "at")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``.

    Lines are equal when the same but for white space at their ends; lines
    without words are not part of runs and stay, unless all other lines of the
    text go: then it is empty. Adds ``n_lines`` and ``n_removed``; columns of
    these names are replaced, all others kept. A null text stays null and has
    one empty line. Rows that repeat an id and its text are one document, and
    each gets its result; ids that repeat with other texts are documents of
    their own. No rows, no result rows.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = (
        repeated_lines(docs.select("doc_id", "text"), min_words)
        .groupBy("doc")
        .agg(F.collect_set("at").alias("gone"))
    )
    doc, lines_gone, n = (free_name(docs.columns, c) for c in ("_doc", "_gone", "_n"))
    gone = materialize(gone.select(F.col("doc").alias(doc), F.col("gone").alias(lines_gone)), "gone")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        _doc_key().alias(doc),
        F.size(_text_lines()).alias(n),
    )
    # The hash table holds the deletions; texts are exchanged, not sorted.
    rows = rows.join(gone.hint("shuffle_hash"), doc, "left")
    numbers = F.array_except(F.sequence(F.lit(0), F.col(n) - 1), F.col(lines_gone))
    left = F.transform(numbers, lambda i: F.get(_text_lines(), i))
    words = F.exists(left, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cleaned = (
        F.when(F.col(lines_gone).isNull(), F.col("text"))
        .when(words, F.array_join(left, "\n"))
        .otherwise(F.lit(""))
    )
    n_removed = F.when(F.col(lines_gone).isNull(), F.lit(0)).otherwise(F.size(lines_gone))
    return rows.select(
        *[cleaned.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns],
        F.col(n).cast("bigint").alias("n_lines"),
        n_removed.cast("bigint").alias("n_removed"),
    )


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of line runs, in its own columns.

    A document that loses all its lines is left out; one that had no words
    stays. ``n_chars``, where there is such a column, is that of the new text.
    """
    columns, removed = docs.columns, free_name(docs.columns, "_removed")
    own = [c for c in columns if c in ("n_lines", "n_removed")]
    held = {c: free_name(columns, f"_own_{c}") for c in own}
    cleaned = dedup_lines(docs.withColumnsRenamed(held), min_words)
    cleaned = cleaned.withColumnRenamed("n_removed", removed).drop("n_lines")
    cleaned = cleaned.withColumnsRenamed({new: c for c, new in held.items()})
    kept = cleaned.where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in columns:
        changed = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return kept.select([F.col(f"`{c}`") for c in columns])
