"""A corpus pipeline: language, near-duplicates, benchmarks, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before it
kept. ``docs`` have doc_id, text, lang and source; n_chars is optional and further columns of
any name are kept up to the last stage. Each row has its own verdict, also without an id or
with an id that others have. What a stage rejects by a join is stored as short keys, whose
measured size decides whether Spark broadcasts them or joins by shuffling. Stages with Python
tasks lower the session's Arrow batches to 500 rows, as rows hold whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm import bpe, decontaminate, language, minhash, private
from fiscalake.llm.common import stored, table, use_small_batches

#: A character of a word, as near-duplicates split them.
WORD = r"[^\x20\x09-\x0D]"


def _row(docs: DataFrame) -> Column:
    """All columns as one struct: whatever they are called, no name clashes with a stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without rows whose text is in none of the languages."""
    # all that a verdict depends on
    others = F.to_json(F.struct(F.col("text").isNull().alias("null"), "doc_id", "source"))
    keyed = docs.select(
        _row(docs).alias("row"), F.sha2(F.concat(others, F.coalesce("text", F.lit(""))), 256).alias("key")
    )
    found = language.identify_languages(
        keyed.select("row.doc_id", "row.text", "row.lang", "row.source", "key"), table(spark, sf_dir, "pages"), carry=["key"]
    )
    rejected = stored(found.where(~F.col("kept")).select("key").distinct(), "rejected")
    return keyed.join(rejected, "key", "left_anti").select("row.*")


def _repeats(rows: DataFrame, group: Column) -> DataFrame:
    """``n`` of all ``rows`` but the first of each group: with an id, of the least id."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rest", "n")
    marked = rows.select("n", order.alias("o"), group.alias("g"))
    first = marked.groupBy("g").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    kept = stored(first.select("g", F.col("first.n").alias("kept")), "first")
    return marked.join(kept, "g").where("n <> kept").select("n")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, and one of equal texts.

    Rows are told apart by a number, not by their id: several texts of an id are judged each,
    and rows without an id like others. The row with the least id stays. Texts without words
    are near nothing; of those only equal rows of an id become one.
    """
    rest = F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
    rows = stored(
        docs.select(_row(docs).alias("row"), F.monotonically_increasing_id().alias("n"), rest.alias("rest")), "numbered"
    )
    numbered = rows.select("row.doc_id", "row.text", "n", "rest")
    text = F.coalesce("text", F.lit(""))
    own = F.when(text.rlike(WORD), F.lit("")).otherwise(F.to_json(F.struct("doc_id", F.col("text").isNull())))
    repeats = stored(_repeats(numbered, F.sha2(F.concat(own, F.lit("|"), text), 256)), "repeats")
    single = numbered.join(repeats, "n", "left_anti")
    found = minhash.near_duplicates(single.select(F.col("n").alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("n"), "component_id")
    near = _repeats(single.select("n", "doc_id", "rest").join(groups, "n"), F.col("component_id"))
    return rows.join(stored(repeats.union(near), "near"), "n", "left_anti").select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without contaminated rows; rows carry their verdict and pass by once."""
    use_small_batches(spark)
    judged = decontaminate.judge_rows(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select("row.*")


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars``, where it is there, follows the text."""
    clean = private.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    use_small_batches(spark)
    return bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("private", private_stage),
    ("tokens", token_stage),
]

#: Trigram models, hashed bands and merges are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
