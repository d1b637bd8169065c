"""Sharding by sampled splitters.

A size-weighted sample of the keys gives quantile boundaries, which cut the key range
into many more ranges than shards. A key that takes up several quantiles gets a range of
its own, and ranges that hold far more than the mean are subdivided by a hash of the
record's id, so that no task sorts a hot group. Counts and bytes of all ranges place
every record exactly: a shard is an equal share of the bytes, cut at whole records. The
law is ``bytes``: shard sizes differ from the mean by at most the largest record.

The key is a hash of the text: equal texts follow each other and share a shard unless a
boundary falls among them.

Cases: a null text has no bytes and the checksum of none (0); repeated rows are placed
each; rows that are equal in id and text are exchangeable among their slots; a null id
is an id like any other; an empty table gives an empty result; a record larger than a
shard's share leaves neighbouring shards smaller or empty; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalake.llm.common import stored, table

SHARDS = 24
#: Ranges for each shard, and sampled keys for each range.
RANGES_PER_SHARD, SAMPLES_PER_RANGE = 32, 20
#: A range is subdivided beyond so many times the mean.
OVERFULL = 2
SEED = 20240229
_UNIT = 1 << 52


def _sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )


def _splitters(records: DataFrame, total: int, ranges: int) -> list[int]:
    """Boundaries between ranges; fewer than ``ranges`` plus the hot keys."""
    chance = F.col("size") * ranges * SAMPLES_PER_RANGE / F.lit(float(total))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "key"), F.lit(_UNIT)) / F.lit(float(_UNIT))
    steps = [k / ranges for k in range(1, ranges)]
    found = (
        records.where(drawn < chance)
        .agg(F.percentile_approx("key", steps, 100 * ranges).alias("q"))
        .first()["q"]
        or []
    )
    hot = {a for a, b in zip(found, found[1:]) if a == b}
    return sorted({*found, *(key + 1 for key in hot)})


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values]).cast("array<bigint>")


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted boundaries are at or below the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda b: b <= key))
    outer = below(longs([g[0] for g in groups]))
    inner = F.get(F.array(*[longs(g) for g in groups]), outer - 1)
    return F.when(outer == 0, 0).otherwise((outer - 1) * step + below(inner))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text)."""
    records = stored(_sizes(docs), "sizes")
    total = records.agg(F.sum("size")).first()[0] or 1
    bounds = _splitters(records, total, shards * ranges_per_shard)
    ranged = records.withColumn("range", range_of(F.col("key"), bounds))

    # one row for each range: their number is fixed by the parameters
    held = {r["range"]: r for r in ranged.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()}
    n_ranges = len(bounds) + 1
    rows = max(1, sum(r["n"] for r in held.values()))
    share = lambda r: max(r["n"] / rows, r["bytes"] / total) * n_ranges
    parts = [max(1, round(share(held[k]))) if k in held and share(held[k]) > OVERFULL else 1 for k in range(n_ranges)]
    first_block = [0, *accumulate(parts)]
    part = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.get(longs(parts), F.col("range")))
    blocked = ranged.withColumn("block", F.get(longs(first_block[:-1]), F.col("range")) + part)

    sums = {r["block"]: r for r in blocked.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()}
    before = lambda what: [
        0, *accumulate(sums[k][what] if k in sums else 0 for k in range(first_block[-1]))
    ]
    in_block = Window.partitionBy("block").orderBy("key", "doc_id")
    row = F.get(longs(before("n")), F.col("block")) + F.row_number().over(in_block) - 1
    upto = F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    # twice the bytes before the middle of the record
    middle = 2 * (F.get(longs(before("bytes")), F.col("block")) + upto) - F.col("size")
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2.0 * total)))
    placed = stored(
        blocked.withColumns({"row": row, "middle": middle}).select(
            "doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), "row"
        ),
        "placed",
    )
    first = {r["shard"]: r["row"] for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    starts = longs([first.get(k, 0) for k in range(shards)])
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.get(starts, F.col("shard"))).alias("slot")
    )


def op8_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
