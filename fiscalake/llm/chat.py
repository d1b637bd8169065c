"""Chat formatting with collapse of cumulative snapshots.

Chat logs often hold a conversation once for every state it passed through. Each turn
gets the hash of all turns up to it; a conversation whose last hash is the hash of a
proper prefix of another one is left out, of equal conversations the smallest id stays,
and the rest is rendered.

A prefix hash is the exclusive or of the hashes of (position, role, text) of its turns,
in two independent 64-bit halves. Positions and hashes are summed up first within blocks
of 64 turn numbers and then over the blocks, so that a conversation with a third of all
rows is not ordered by one task, and rendered text comes in parts, one for each block.

Cases: turns without ``conv_id`` belong to no conversation and are left out; a null turn
number comes first; turns with equal numbers are ordered by role and by a hash of their
text; repeated rows are repeated turns; a null role is rendered as ``unknown``, a null text
as empty, but neither equals an empty one in the comparison; markers inside a text are
broken up; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalake.llm.common import stored, table

BLOCK = 64
FIRST = -(1 << 62)

_KEY = ["conv_id", "block"]
_ORDER = ["at", "role", "content_a", "content_b"]


def _turns(conversations: DataFrame) -> DataFrame:
    at = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST))
    content = lambda seed: F.xxhash64(
        F.lit(seed), F.col("role").isNull(), F.coalesce("role", F.lit("")),
        F.col("text").isNull(), F.coalesce("text", F.lit("")),
    )
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.floor(at / BLOCK).alias("block"),
        at.alias("at"),
        "role",
        "text",
        content(1).alias("content_a"),
        content(2).alias("content_b"),
    )


def _positions(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns without text but with ``pos`` (from 1) and both prefix hashes; their blocks."""
    local = Window.partitionBy(*_KEY).orderBy(*_ORDER)
    running = local.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block")
    blocks = (
        turns.groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "before": F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
                "n_turns": F.sum("n").over(Window.partitionBy("conv_id")),
                "part": F.row_number().over(earlier) - 1,
            }
        )
        .drop("n")
    )
    placed = (
        turns.drop("text")
        .withColumn("local", F.row_number().over(local))
        .join(blocks, _KEY)
        .withColumn("pos", F.col("before") + F.col("local"))
    )
    term = lambda seed: F.xxhash64(F.lit(seed), "pos", "content_a", "content_b")
    hashed = placed.withColumns({"term_a": term(3), "term_b": term(4)})
    inner = hashed.select(
        *_KEY,
        "pos",
        "n_turns",
        F.bit_xor("term_a").over(running).alias("inner_a"),
        F.bit_xor("term_b").over(running).alias("inner_b"),
    )
    upto = earlier.rowsBetween(Window.unboundedPreceding, -1)
    outer = (
        hashed.groupBy(*_KEY)
        .agg(F.bit_xor("term_a").alias("a"), F.bit_xor("term_b").alias("b"))
        .select(
            *_KEY,
            F.coalesce(F.bit_xor("a").over(upto), F.lit(0)).alias("outer_a"),
            F.coalesce(F.bit_xor("b").over(upto), F.lit(0)).alias("outer_b"),
        )
    )
    prefixes = inner.join(outer, _KEY).select(
        "conv_id",
        "pos",
        "n_turns",
        F.col("inner_a").bitwiseXOR(F.col("outer_a")).alias("hash_a"),
        F.col("inner_b").bitwiseXOR(F.col("outer_b")).alias("hash_b"),
    )
    return prefixes, blocks


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_copies): one conversation of each content that prefixes no longer one."""
    state = ["pos", "hash_a", "hash_b"]
    whole = (
        prefixes.where(F.col("pos") == F.col("n_turns"))
        .groupBy(*state)
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    proper = prefixes.where(F.col("pos") < F.col("n_turns")).select(*state).distinct()
    return whole.join(proper, state, "left_anti").select("conv_id", "n_copies")


def _rendered(role: Column, text: Column) -> Column:
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), plain, F.lit("<|end|>\n"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, rendered) of the maximal conversations.

    The parts of a conversation, put together in their order, are its text.
    """
    turns = _turns(conversations)
    prefixes, blocks = _positions(turns)
    prefixes = stored(prefixes, "prefixes")
    kept = blocks.join(maximal_conversations(prefixes), "conv_id")
    piece = F.struct("at", "role", "content_a", "content_b", _rendered(F.col("role"), F.col("text")).alias("piece"))
    return (
        turns.select(*_KEY, piece.alias("turn"))
        .join(kept.select(*_KEY, "part", "n_turns", "n_copies"), _KEY)
        .groupBy(*_KEY)
        .agg(
            F.first("part").cast("long").alias("part"),
            F.first("n_turns").alias("n_turns"),
            F.first("n_copies").alias("n_copies"),
            F.array_join(F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["piece"]), "").alias("rendered"),
        )
        .drop("block")
    )


def op4_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(table(spark, sf_dir, "conversations"))


OP4_SQL = """
with conv as (
  select conv_id, list(struct_pack(r := role, t := text) order by turn nulls first, role) as turns
  from conversations where conv_id is not null group by conv_id),
whole as (
  select min(conv_id) as conv_id, turns, len(turns) as n, count(*) as n_copies from conv group by turns),
shorter as (
  select distinct list_slice(turns, 1, k) as turns
  from (select turns, unnest(range(1, len(turns))) as k from conv)),
kept as (select * from whole where not exists (select 1 from shorter s where s.turns = whole.turns)),
parts as (
  select conv_id, turn // 64 as block, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10)
    || replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10), '' order by turn) as rendered
  from conversations where conv_id in (select conv_id from kept) group by all)
select conv_id, row_number() over (partition by conv_id order by block) - 1 as part,
  n::bigint as n_turns, n_copies, rendered
from parts join kept using (conv_id)
"""
