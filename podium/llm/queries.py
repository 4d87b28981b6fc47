"""The operators bound to the given tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.brown import score_documents
from podium.llm.decontaminate import contaminated
from podium.llm.exact_dedup import exact_dedup
from podium.llm.licenses import scan_licences
from podium.llm.line_dedup import MIN_WORDS, dedup_lines
from podium.llm.nbsvm import classify
from podium.llm.packing import pack_documents
from podium.llm.piece_codec import decode_documents, encode_documents
from podium.llm.pseudonyms import pseudonymise
from podium.llm.resample import importance_ranks
from podium.llm.set_join import set_components
from podium.llm.tables import SCHEMAS, table
from podium.llm.token_files import token_files
from podium.llm.vector_codes import coded_with_errors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@_query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query(
    "op2_exact_dedup",
    r"""
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
          FROM documents)
    WINDOW g AS (PARTITION BY norm)
    """,
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, since a stream takes a single file only as the match of one.
    files = f"{sf_dir}/document[s].parquet"
    stream = spark.readStream.schema(SCHEMAS["documents"]).parquet(files)
    return exact_dedup(stream, table(spark, sf_dir, "documents"))


# Every smallest run of MIN_WORDS words, from its first line on or up to its last, by its lines.
@_query(
    "op3_line_dedup",
    rf"""
    WITH split AS (
        SELECT doc_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
    l AS (
        SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
               len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w,
               row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
        FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    c AS (
        SELECT *, sum(w) OVER d AS after, sum(w) OVER d - w AS before,
               sum(w) OVER (PARTITION BY doc_id) AS total
        FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
    m AS (
        SELECT *, count(*) OVER (PARTITION BY doc_id ORDER BY before
                   RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING) AS ahead,
               count(*) OVER (PARTITION BY doc_id ORDER BY after
                   RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW) AS behind
        FROM c),
    runs AS (
        SELECT doc_id, pos AS s, ahead AS m FROM m WHERE total - before >= {MIN_WORDS}
        UNION SELECT doc_id, pos - behind + 1, behind FROM m WHERE after >= {MIN_WORDS}),
    texts AS (SELECT doc_id, list(line ORDER BY pos) AS lines FROM l GROUP BY doc_id),
    keyed AS (
        SELECT doc_id, s, m, array_to_string(lines[s:s + m - 1], chr(10)) AS run
        FROM runs JOIN texts USING (doc_id)),
    later AS (
        SELECT doc_id, s, m FROM (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS nth FROM keyed)
        WHERE nth > 1),
    gone AS (
        SELECT DISTINCT doc_id, line_no FROM (
            SELECT doc_id, unnest(generate_series(s, s + m - 1)) AS pos FROM later)
        JOIN l USING (doc_id, pos)),
    kept AS (
        SELECT doc_id, count(*) AS n_lines, count(g.line_no) AS n_removed,
               string_agg(s.line, chr(10) ORDER BY s.line_no) FILTER (g.line_no IS NULL) AS rest
        FROM split s LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id)
    SELECT doc_id, n_lines, n_removed,
           CASE WHEN n_removed = 0 THEN text
                WHEN regexp_matches(coalesce(rest, ''), '[^\x20\x09-\x0D]') THEN rest
                ELSE '' END AS text
    FROM documents JOIN kept USING (doc_id)
    """,
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents)


@_query("op4_set_join")
def op4_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_components(table(spark, sf_dir, "documents"), n=3, percent=90)


@_query("op5_brown_model")
def op5_brown_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@_query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op7_pseudonyms")
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(documents, key="key of the registered query")


@_query("op8_licence_scan")
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no paths: a document's source and number stand for them.
    path = F.format_string(
        "%s/%d/%d/%d",
        F.coalesce("source", F.lit("none")),
        F.floor(F.col("doc_id") / 1000),
        F.floor(F.pmod("doc_id", F.lit(1000)) / 50),
        F.col("doc_id"),
    )
    return scan_licences(table(spark, sf_dir, "documents").withColumn("path", path))


@_query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )


@_query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )


@_query("op11_importance_resampling")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def _lloyd_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Lloyd rounds as one statement: every assignment compares all entries."""

    def assigned(n: int) -> str:
        # Whole numbers: the products are exact as doubles.
        return f"""
    a{n} AS MATERIALIZED (
        SELECT vec_id, label, part, arg_min(idx, (d, idx)) AS idx, min(d) AS d FROM (
            SELECT v.*, c.idx, list_inner_product(v.vec, v.vec) - 2 * list_inner_product(v.vec, c.vec)
                       + list_inner_product(c.vec, c.vec) AS d
            FROM v JOIN c{n} c USING (part))
        GROUP BY vec_id, label, part)"""

    def replaced(n: int) -> str:
        return f"""
    c{n + 1} AS MATERIALIZED (
        SELECT part, idx, coalesce(m.vec, c.vec) AS vec FROM c{n} c LEFT JOIN (
            SELECT part, idx, list(mean ORDER BY pos) AS vec FROM (
                SELECT part, idx, pos, floor(sum(x) / count(*)) AS mean FROM (
                    SELECT part, idx, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos
                    FROM v JOIN a{n} USING (vec_id, part))
                GROUP BY part, idx, pos)
            GROUP BY part, idx) m USING (part, idx))"""

    steps = [step for n in range(rounds) for step in (assigned(n), replaced(n))] + [assigned(rounds)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec,
               len(embedding) // {parts} AS w
        FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    v AS MATERIALIZED (
        SELECT vec_id, label, part, vec[part * w + 1:part * w + w] AS vec
        FROM kept, range({parts}) r(part)),
    c0 AS MATERIALIZED (
        SELECT part, idx, vec FROM (
            SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS idx FROM v)
        WHERE idx < {entries}),
    {",".join(steps)},
    digest AS (
        SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, idx, pos)) AS codebooks_sha256
        FROM (SELECT part, idx, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos FROM c{rounds})),
    coded AS (
        SELECT vec_id, label, string_agg(format('{{:02x}}', idx), '' ORDER BY part) AS code,
               sum(d)::BIGINT AS error
        FROM a{rounds} GROUP BY vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           codebooks_sha256
    FROM coded, digest
    """


@_query("op12_vector_codes", _lloyd_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_with_errors(table(spark, sf_dir, "embeddings"))


@_query("op13_piece_codec")
def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_documents(documents, model).drop("text")
    decoded = decode_documents(encoded, model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("ids_agree") & F.col("text_agrees")).alias("agrees"),
    )
