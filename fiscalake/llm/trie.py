"""Prefix trie of conversations.

Turns become ids, a digest of role and text with the number of words behind it. Ids stand in
positional columns, one row for each conversation and block of columns, and Spark's ROLLUP
over the columns aggregates all prefixes of a block together; ``grouping_id`` tells how long
a prefix is. The first block has few columns, as most conversations are short. Longer ones go
on in further blocks, whose groups are keyed by the node that the block before ended in.

A node is known by its depth and the exclusive or of the hashes of (position, id) on its path,
in two independent 64-bit halves; so its parent's key follows from its own. With that, children
are counted and find their parents. Each node is named after its smallest member; the nodes
named after one conversation are a chain, whose sums run from its end to its top and then go
on to the node where the chain hangs: as many rounds as chains hang on chains, no matter how
long conversations are.

Cases: turns without ``conv_id`` belong to no conversation; a null turn number comes first;
turns with equal numbers are ordered by their content and repeated rows are turns each; a
null role or text is an empty one; a conversation in which nothing is left is a member of
the root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalake.llm.common import numbered, stored, table
from fiscalake.llm.manifest import CRC32_SQL

#: Columns of the first block and of all others.
FIRST, NEXT = 8, 32
#: Bytes of a turn id that hold its digest; eight hold its words.
DIGEST = 16
#: A node with more children is joined apart, and depths that are summed up together.
HOT, DEPTHS = 10_000, 64
#: Turns of a conversation that are joined by one key.
STRETCH = 4096
#: Conversation ids that are joined to one text before they are hashed.
CHUNK = 10_000

WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "a", "b"]


def turn_id(role: Column, text: Column) -> Column:
    """Digest of role and text, then the number of words of the text."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(WORD))
    return F.unhex(F.concat(F.substr(digest, F.lit(1), F.lit(2 * DIGEST)), F.lpad(F.hex(words), 16, "0")))


def _words(turn: Column) -> Column:
    return F.conv(F.hex(F.substr(turn, F.lit(DIGEST + 1))), 16, 10).cast("long")


def _term(seed: int, pos: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("long"), turn)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, n, turn_id) of every turn of a conversation."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_id(F.col("role"), F.col("text")).alias("turn_id"),
    )
    placed = numbered(stored(turns, "turns"), ["conv_id"], ["turn", "turn_id"], "turns-in-order")
    return stored(placed.select("conv_id", "pos", "n", "turn_id"), "turns-placed")


def _block_of(pos: Column) -> Column:
    return F.when(pos < FIRST, F.lit(0).cast("long")).otherwise(F.floor((pos - FIRST) / NEXT) + 1)


def _start_of(block: Column) -> Column:
    return F.when(block == 0, F.lit(0).cast("long")).otherwise((block - 1) * NEXT + FIRST)


def _blocks(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, block, ids, a, b): the ids of a block's turns, and the node before the block.

    Every row of ``members`` (conv_id) has its first block, perhaps without ids.
    """
    turn = F.struct("pos", "turn_id")
    pos = F.col("pos")
    held = (
        turns.withColumn("block", _block_of(pos))
        .groupBy("conv_id", "block")
        .agg(
            F.transform(F.sort_array(F.collect_list(turn)), lambda t: t["turn_id"]).alias("ids"),
            F.bit_xor(_term(1, pos, F.col("turn_id"))).alias("own_a"),
            F.bit_xor(_term(2, pos, F.col("turn_id"))).alias("own_b"),
        )
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    upto = lambda own: F.coalesce(F.bit_xor(own).over(before), zero)
    keyed = held.select("conv_id", "block", "ids", upto("own_a").alias("a"), upto("own_b").alias("b"))
    empty = members.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", zero.alias("block"), F.array().cast("array<binary>").alias("ids"), zero.alias("a"), zero.alias("b")
    )
    return keyed.unionByName(empty)


def _rolled_up(blocks: DataFrame, width: int) -> DataFrame:
    """(depth, a, b, up_a, up_b, words, conv_id, n_convs): a row for each prefix that ends in the block."""
    columns = [f"t{k}" for k in range(width)]
    rows = blocks.select("block", "a", "b", "conv_id", *[F.get("ids", F.lit(k)).alias(c) for k, c in enumerate(columns)])
    found = rows.sparkSession.sql(
        f"""select block, a, b, {', '.join(columns)}, grouping_id() as gid,
              min(conv_id) as conv_id, count(*) as n_convs
            from {{rows}} group by block, a, b, rollup({', '.join(columns)})""",
        rows=rows,
    )
    # of the columns that are left out, each sets a bit
    found = found.withColumn("own", F.lit(width) - F.length(F.replace(F.bin("gid"), F.lit("0"), F.lit(""))))
    ids = F.slice(F.array(*columns), F.lit(1), F.col("own"))
    last = F.element_at("ids", -1)
    # a conversation that is over has no longer prefixes, and the empty one belongs to the block before
    is_node = F.when(F.col("own") == 0, F.col("block") == 0).otherwise(last.isNotNull())
    start = _start_of(F.col("block"))

    def key(name: str, seed: int) -> tuple[Column, Column]:
        terms = F.transform("ids", lambda t, i: _term(seed, start + i, t))
        whole = F.aggregate(terms, F.col(name), lambda x, y: x.bitwiseXOR(y))
        return whole, whole.bitwiseXOR(F.element_at(terms, -1))

    (a, up_a), (b, up_b) = key("a", 1), key("b", 2)
    none = F.col("own") == 0
    return (
        found.withColumn("ids", F.when(F.col("own") > 0, ids).otherwise(F.array().cast("array<binary>")))
        .withColumn("last", F.when(~none, last))
        .where(is_node)
        .select(
            (start + F.col("own")).cast("long").alias("depth"), a.alias("a"), b.alias("b"),
            F.when(~none, up_a).alias("up_a"), F.when(~none, up_b).alias("up_b"),
            F.coalesce(F.when(~none, _words(F.col("last"))), F.lit(0).cast("long")).alias("words"),
            "conv_id", "n_convs",
        )
    )


def prefix_nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each node of the trie of all ``members``; columns as :func:`_rolled_up` has them."""
    blocks = stored(_blocks(turns, members), "turn-blocks")
    first = _rolled_up(blocks.where("block = 0"), FIRST)
    further = _rolled_up(blocks.where("block > 0"), NEXT)
    return stored(first.unionByName(further), "nodes")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with n_children and parent_conv_id."""
    spark = nodes.sparkSession
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    counted = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    held = stored(
        nodes.join(counted, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "nodes-with-children",
    )
    # a child named after its parent's own member needs no search
    named = lambda df: df.select(*_NODE, F.col("conv_id").alias("parent"))
    parents = held.where("n_children > 0")
    root = spark.createDataFrame([tuple(r) for r in named(held.where("depth = 0")).collect()], "depth bigint, a bigint, b bigint, root bigint")
    child = held.withColumns({"d": F.col("depth") - 1})
    search = lambda df, into: df.select(
        F.col("depth").alias("d"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("parent").alias(into)
    )
    # one row for the root; few nodes have very many children, whatever else is joined by key
    hot = stored(named(parents.where((F.col("n_children") > HOT) & (F.col("depth") > 0))), "hot-nodes")
    others = named(parents.where((F.col("n_children") <= HOT) & (F.col("depth") > 0)))
    found = child.join(F.broadcast(root.select(F.col("depth").alias("d"), "root")), "d", "left").join(
        search(hot, "hot"), ["d", "up_a", "up_b"], "left"
    )
    known = found.where(F.col("root").isNotNull() | F.col("hot").isNotNull() | (F.col("depth") == 0))
    rest = found.where(F.col("root").isNull() & F.col("hot").isNull() & (F.col("depth") > 0))
    rest = rest.join(search(others, "parent"), ["d", "up_a", "up_b"])
    columns = ["depth", "a", "b", "words", "conv_id", "n_convs", "n_children"]
    known = known.select(*columns, F.coalesce("root", "hot").alias("parent_conv_id"))
    return stored(known.unionByName(rest.select(*columns, F.col("parent").alias("parent_conv_id"))), "nodes-with-parents")


def _subtree_sums(nodes: DataFrame, own: dict[str, Column]) -> DataFrame:
    """(conv_id, depth, *own) with each column of ``own`` summed over the node's subtree."""
    names = list(own)
    sums = [F.sum(n).alias(n) for n in names]
    gains = stored(nodes.select("conv_id", "depth", *[c.alias(n) for n, c in own.items()]), "gains")
    top = nodes.where((F.col("parent_conv_id") != F.col("conv_id")) & (F.col("depth") > 0))
    hangs = stored(
        top.select("conv_id", F.col("parent_conv_id").alias("to"), (F.col("depth") - 1).alias("at")), "chains"
    )
    new, every = gains, gains
    while True:
        totals = new.groupBy("conv_id").agg(*sums)
        new = stored(
            totals.join(hangs, "conv_id")
            .groupBy(F.col("to").alias("conv_id"), F.col("at").alias("depth"))
            .agg(*sums),
            "gains",
        )
        if new.isEmpty():
            break
        every = every.unionByName(new)
    # from a chain's end: sums of its stretches of depths, then inside a stretch
    stretch = F.expr(f"depth div {DEPTHS}").alias("stretch")
    each = every.groupBy("conv_id", "depth", stretch).agg(*sums)
    later = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    beyond = each.groupBy("conv_id", "stretch").agg(*sums).select(
        "conv_id", "stretch", *[F.coalesce(F.sum(n).over(later), zero).alias(f"{n}_beyond") for n in names]
    )
    inside = (
        Window.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        each.select("conv_id", "depth", "stretch", *[F.sum(n).over(inside).alias(n) for n in names])
        .join(beyond, ["conv_id", "stretch"])
        .select("conv_id", "depth", *[(F.col(n) + F.col(f"{n}_beyond")).alias(n) for n in names])
    )


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of (depth, a, b, conv_id): the ids joined by commas, ascending.

    Sorted ranges first join ids to chunks, so a node with most conversations is many tasks'
    work; only its hash, which has to be taken from left to right, passes over the chunks.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids = None, []

        def out() -> pa.RecordBatch:
            values = [*here, ids[0], ",".join(map(str, ids))]
            return pa.RecordBatch.from_pydict(dict(zip([*_NODE, "first", "ids"], ([v] for v in values))), schema=chunk_schema)

        for batch in batches:
            for *node, conv_id in zip(*(batch.column(n).to_pylist() for n in [*_NODE, "conv_id"])):
                if ids and (node != here or len(ids) == CHUNK):
                    yield out()
                    ids = []
                here = node
                ids.append(conv_id)
        if ids:
            yield out()

    chunk_schema = pa.schema([*[(n, pa.int64()) for n in [*_NODE, "first"]], ("ids", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, running = None, None
        done: list[tuple] = []
        for batch in batches:
            for *node, ids in zip(*(batch.column(n).to_pylist() for n in [*_NODE, "ids"])):
                if node == here:
                    running.update(b",")
                else:
                    if here:
                        done.append((*here, running.hexdigest()))
                    here, running = node, hashlib.sha256()
                running.update(ids.encode())
        if here:
            done.append((*here, running.hexdigest()))
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip([*_NODE, "ends_sha256"], zip(*done))))

    return (
        ends.repartitionByRange(parts, *_NODE, "conv_id")
        .sortWithinPartitions(*_NODE, "conv_id")
        .mapInArrow(chunks, "depth bigint, a bigint, b bigint, first bigint, ids string")
        .repartition(parts, *_NODE)
        .sortWithinPartitions(*_NODE, "first")
        .mapInArrow(digests, "depth bigint, a bigint, b bigint, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each node of the trie of conversations.

    ``turns`` are (conv_id, pos, turn_id), positions from 0 without gaps, ``members`` (conv_id) the
    distinct conversations, also those without turns. Returned are conv_id (the smallest member;
    with ``depth`` it tells nodes apart), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    nodes = _with_parents(prefix_nodes(turns, members))
    own = {
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
    }
    sums = _subtree_sums(nodes, own)
    whole = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("depth"),
        F.bit_xor(_term(1, F.col("pos"), F.col("turn_id"))).alias("a"),
        F.bit_xor(_term(2, F.col("pos"), F.col("turn_id"))).alias("b"),
    )
    zero = F.lit(0).cast("long")
    ends = members.join(whole, "conv_id", "left").select(*[F.coalesce(c, zero).alias(c) for c in _NODE], "conv_id")
    none = hashlib.sha256().hexdigest()
    return (
        nodes.join(_joined_ids(stored(ends, "ends")), _NODE, "left")
        .join(sums, ["conv_id", "depth"])
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of conversations that begin like the first of their ``every`` ids.

    A conversation takes over the first h turns of that one, if it exists, in place of its own
    first h; h is the checksum of its id modulo ``heads``.
    """
    stretch = lambda pos: F.expr(f"{pos} div {STRETCH}")
    own = turns.groupBy("conv_id").agg(F.first("n").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("long")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = own.select("conv_id", "n", h.alias("h"), base).join(sizes, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    plan = stored(plan.select("conv_id", "n", "base", "h", taken.alias("taken")), "rebuilt-plan")
    first = turns.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "turn_id")
    borrowed = plan.where("taken > 0").join(first, "base").where("pos < taken").select("conv_id", "pos", "turn_id")
    # a long conversation is joined by stretches of its turns
    stretches = F.explode(F.sequence(F.lit(0).cast("long"), stretch("n")))
    kept = (
        turns.select("conv_id", "pos", "turn_id", stretch("pos").alias("stretch"))
        .join(plan.select("conv_id", "h", "taken", stretches.alias("stretch")), ["conv_id", "stretch"])
        .where("pos >= h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id")
    )
    return stored(borrowed.unionByName(kept), "rebuilt"), plan.select("conv_id")


def op13_prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(turns_in_order(table(spark, sf_dir, "conversations"))))


OP13_SQL = f"""
with conv as (
  select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    order by turn nulls first, role nulls first, text nulls first) as own, {CRC32_SQL.format("conv_id")} % 4 as h
  from conversations where conv_id is not null group by conv_id),
rebuilt as (
  select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) as path
  from conv c left join conv b on b.conv_id = c.conv_id - c.conv_id % 20),
node as (
  select path[1:d] as p, d, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(path) = d), '')) as ends_sha256
  from (select conv_id, path, unnest(range(0, len(path) + 1)) as d from rebuilt) group by all),
child as (select p[1:d - 1] as p, count(*) as n from node where d > 0 group by all),
weighed as (
  select node.*, coalesce(child.n, 0) as n_children,
    case when d = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) end as saved
  from node left join child using (p)),
sums as (
  select p[1:k] as p, sum((n_children = 0)::bigint)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
  from (select p, n_children, saved, unnest(range(0, d + 1)) as k from weighed) group by all)
select w.conv_id, w.d as depth, up.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
from weighed w join sums using (p) left join node up on w.d > 0 and up.p = w.p[1:w.d - 1]
"""
