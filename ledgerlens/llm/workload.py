"""The registered queries over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secrets,
    sentencepiece,
    sharding,
    spelling,
    url_filter,
    vector_dedup,
    vector_search,
)
from ledgerlens.llm.oracles import ORACLE as SEARCH_ORACLE
from ledgerlens.llm.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short_lines=True)
    return cleaned.select(
        "row.doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def quality_trees(spark: SparkSession, sf_dir: str, documents: DataFrame) -> quality.Trees | None:
    labels = table(spark, sf_dir, "labels").filter(remainder(4) != 2)
    return quality.train(documents, labels.select("doc_id", "quality"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(documents, quality_trees(spark, sf_dir, documents))
    predicted = (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", predicted)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(documents.filter(remainder(3) != 1))
    found = language_id.predict(documents, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw_mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.size("shards")
    return drawn.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece.encode_texts(table(spark, sf_dir, "documents"), sentencepiece.read_vocabulary())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "exact")


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of an id is taken as the outcome of the page with that id; bad is low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), outcomes)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_line_dedup,
        op3_quality,
        op4_near_dedup,
        op5_language_id,
        op6_mixing,
        op7_sharding,
        op8_sentencepiece,
        op9_vector_dedup,
        op10_vector_search,
        op11_lexical_search,
        op12_spelling,
        op13_url_filter,
    )
}

# The mix rests on md5, on whole-number sums and on one division, which both engines do alike.
ORACLE = {
    "op6_mixing": r"""
WITH rows_ AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
weighed AS (
    SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sources),
levels AS (  -- sources by the level at which they reach their limit; `level` if all before are at theirs
    SELECT *, 2 * source_size AS capacity,
           (3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER before, 0))::BIGINT AS left_,
           (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weights,
           row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS nth
    FROM weighed
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT arg_min(left_ / (2 * weights), nth) FILTER (capacity::DOUBLE > weight * (left_ / (2 * weights))) AS level FROM levels),
targets AS (
    SELECT source, source_size,
           CASE WHEN capacity::DOUBLE > weight * level THEN weight * level ELSE capacity::DOUBLE END AS target
    FROM levels, level),
placed AS (
    SELECT r.*, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
           sum(r.size) OVER (PARTITION BY r.source ORDER BY r.place) AS after_
    FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
rest AS (
    SELECT *, target - whole * source_size AS rest FROM placed),
cuts AS (
    SELECT source, max(place) FILTER (after_ <= rest) AS cut, any_value(rest) - coalesce(max(after_) FILTER (after_ <= rest), 0) AS gap
    FROM rest GROUP BY source),
extras AS (  -- the one row beyond the cut that fills the gap best
    SELECT r.source, min({'off': abs(gap - size), 'place': place}) AS best
    FROM rest r JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
    WHERE place > coalesce(cut, -1) AND abs(gap - size) < gap GROUP BY r.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN place <= coalesce(cut, -1) OR place = coalesce(best.place, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rest r JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
LEFT JOIN extras e ON r.source IS NOT DISTINCT FROM e.source""",
} | SEARCH_ORACLE
