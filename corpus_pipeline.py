"""From raw documents to packed training sequences, in stages.

Each stage reads the documents that the one before it kept. All but the last return the columns
of their input. A table may hold nulls in any column, equal rows, and columns beside doc_id and
text, whatever they are called; stages carry those along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontaminate, minhash, packing, quality, secrets
from tradewind.llm.columns import all_columns, spare_name
from tradewind.session import configure, keep, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stored(docs: DataFrame, label: str) -> DataFrame:
    """Write whole documents, packed more tightly than short tables are."""
    path = scratch_path(docs.sparkSession, label)
    docs.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules reject go: those that fail the base rules (fewer than ten words,
    or over a fifth of the words in repeated windows) and those that are more likely bad than
    good by the rules' votes. A null text has no words."""
    configure(spark)
    mark = spare_name(docs, "votes")
    counted = docs.withColumn(mark, quality.statistics(F.col("text")))
    counted = _stored(quality.with_votes(counted, mark), "votes")
    model = quality.fit_votes(counted, mark)
    return counted.where(quality.verdict(model, mark)).select(*all_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies (at least 80 % of their five-word shingles in
    common) stays: the one with the least doc_id.

    A document without words is in no group, unless it equals another one in all columns. Of
    the rows of a group with its least id, or of all if none has an id, one stays.
    """
    configure(spark)
    row = spare_name(docs, "row_print")
    marked = docs.withColumn(row, F.xxhash64(*all_columns(docs)))
    rows = marked.select("doc_id", F.col(row).alias("row_print"), "text")
    found = keep(minhash.near_duplicates(rows, ["doc_id", "row_print"], percent=80), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_print"))["row_print"]
    groups = found.groupBy(F.coalesce("group", "row_print").alias("group")).agg(first.alias("chosen"))
    chosen = keep(groups.select(F.col("chosen").alias(row)), "chosen")
    return marked.join(chosen.hint("merge"), row, "left_semi").dropDuplicates([row]).select(*all_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that overlap an item of the table ``benchmark`` go."""
    configure(spark)
    row = spare_name(docs, "row_print")
    marked = docs.withColumn(row, F.xxhash64(*all_columns(docs)))
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = marked.select(F.col(row).alias("row_print"), "text")
    leaked = keep(decontaminate.contaminated(rows, benchmark, ["row_print"]), "leaked")
    return marked.join(leaked.withColumnRenamed("row_print", row), row, "left_anti").select(*all_columns(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are replaced by the name of their kind in brackets; documents stay. n_chars,
    where there is such a column, follows the text."""
    configure(spark)
    others, mark = [c for c in docs.columns if c != "text"], spare_name(docs, "n_spans")
    renamed = {c: f"c{i}" for i, c in enumerate(others)}
    rows = docs.select(*[c.alias(renamed.get(n, n)) for n, c in zip(docs.columns, all_columns(docs), strict=True)])
    found = secrets.with_secrets(rows, list(renamed.values()))
    text = secrets.redacted(F.col("text"), F.col("spans")).alias("text")
    clean = found.select(*[F.col(n).alias(c) for c, n in renamed.items()], text, F.size("spans").alias(mark))
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        follows = F.when(F.col(mark) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", follows)
    return clean.select(*all_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their token ids."""
    configure(spark)
    return packing.packed(docs, ["doc_id"], public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# Expectation maximisation, MinHash groups and dynamic programming are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each one's rows are written and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = _stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
