"""Each operator over its whole table, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import alignment, boosting, decontaminate, kneser_ney, minhash, negatives, packing, paragraphs, quality, secrets, shards, toxicity, wrappers
from tradewind.session import configure, keep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str = "documents", sql: str | None = None):
    """Register a function of the session, a table and the folder of tables."""

    def register(fn: Callable[[SparkSession, DataFrame, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return fn(spark, spark.read.parquet(f"{folder}/{table}.parquet"), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _language_model(docs: DataFrame, order: int) -> DataFrame:
    """Scores of all documents under a model of those that are not held out."""
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    held_out = F.coalesce(part == 2, F.lit(False))
    model = kneser_ney.train(docs.where(~held_out), order=order)
    found = kneser_ney.scored(docs, model, ["doc_id"])
    tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", tokens, "base_score", "score")


@query("op1_kneser_ney")
def op1(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return _language_model(docs, 2)


@query("op1_kneser_ney_trigram")
def op1_trigram(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return _language_model(docs, 3)


@query("op2_paragraph_dedup")
def op2(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return paragraphs.repeated_spans(docs).drop("text_key")


@query("op3_quality_rules")
def op3(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found, _ = quality.scored(docs, ["doc_id"], keep)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *base, "base_failed", "kept", "posterior")


@query("op4_sharding")
def op4(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_print"),
    )
    found = shards.sharded(rows, ["doc_id", "size", "text_print"], 24, seed=17)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found = minhash.one_per_group(minhash.near_duplicates(docs, ["doc_id"], percent=85))
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id", "kept")


@query("op6_secret_scan")
def op6(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found = secrets.with_secrets(docs, ["doc_id"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE_RULES]))
    return found.select(
        "doc_id",
        *[number(r.kind) for r in secrets.BASE_RULES],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op7_wrapper_induction", table="pages")
def op7(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    found = wrappers.extracted(pages)
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op8_packing")
def op8(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found = packing.packed(docs, ["doc_id"], public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pairs of documents and benchmark items that overlap, with their longest overlap."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.overlaps(docs, benchmark, ["doc_id"])
    best = F.max(F.struct("n_equal", F.negative("n_words").alias("n"), F.negative("text_start").alias("t"), F.negative("item_start").alias("i")))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select(
        "doc_id",
        "item_id",
        F.negative("b.t").alias("text_start"),
        F.negative("b.i").alias("item_start"),
        F.negative("b.n").alias("n_words"),
        F.col("b.n_equal").alias("n_equal"),
    )


@query("op10_quality_trees")
def op10(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    held_out = F.coalesce(part == 0, F.lit(False))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = keep(boosting.featured(docs, ["doc_id"]), "features")
    model = boosting.train(found, labels.where(~held_out))
    scores = boosting.scored(found, model, ["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query(
    "op11_hard_negatives",
    table="embeddings",
    sql="""
    WITH whole AS (
      SELECT row_number() OVER () AS row, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT a.row, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             list_inner_product(a.v, b.v)::BIGINT AS score
      FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id),
    positives AS (
      SELECT row, anchor_id, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place
      FROM scores WHERE same QUALIFY place <= 5)
    SELECT p.anchor_id, p.positive_id,
           row_number() OVER (PARTITION BY p.row, p.place ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
           n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positives p JOIN scores n
      ON n.row = p.row AND NOT n.same
         AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
    QUALIFY rank <= 10
    """,
)
def op11(spark: SparkSession, vectors: DataFrame, folder: str) -> DataFrame:
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, F.pmod("vec_id", F.lit(100)) == 0)


@query("op12_toxicity")
def op12(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(part == 2, F.lit(False))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(docs, labels.where(~held_out))
    scores = toxicity.scored(docs, model, ["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query("op13_token_alignment")
def op13(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.linked(docs, ["doc_id"], *paths)
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return found.select("doc_id", *numbers, F.col("groups").alias("groups_sha256"))
