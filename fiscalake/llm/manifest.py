"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf; the leaves of a source form a tree of three children to a node, and
the roots of the sources form the tree above. A witness is what a leaf needs to prove that it
belongs to the root: the digests beside its path, from the leaf up.

Leaves are appended as a stream, in blocks that are aligned to the tree: a block of
``3 ** BLOCK_LEVELS`` leaves is a complete subtree. An appended leaf starts with an empty
witness. Each sibling that completes a run closes a subtree and extends the witnesses of all
leaves below it, so no tree is ever built and walked. Blocks are dealt over the tasks. Their
roots are further appends, one level of blocks higher, until a source has one block; the
roots of the sources are appended in the same way. A leaf's whole witness is its own, then
its block's, and so on.

Cases: null columns are digested as ``-``; a null source is a source of its own, the first
one, and a null id the least; rows that are equal in source and id are ordered by their
digest, repeated rows are leaves each; an empty or very long text is a leaf like others; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import numbered, stored, table

ARITY = 3
#: Levels of a block: 243 leaves.
BLOCK_LEVELS = 5
BLOCK = ARITY**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value with its length before it, ``-`` where it is null."""
    text = [v.cast("string") for v in values]
    each = [
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in text
    ]
    return F.sha2(F.concat(*each), 256)


def node_digest(children: Sequence[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


class Frontier:
    """The open runs of a growing tree, and the witness of every leaf as far as it is known.

    A step of a witness is a byte, ``4 * place + size of the run``, and the digests beside it.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = []
        self.witnesses: list[bytearray] = []
        self.steps: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append(bytearray())
        self.steps.append(bytearray())
        self._add(0, leaf, at, at + 1)

    def _add(self, level: int, digest: bytes, start: int, end: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, start, end))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _, _ in run]
        for place, (_, start, end) in enumerate(run):
            beside = b"".join(digests[:place] + digests[place + 1 :])
            for leaf in range(start, end):
                self.witnesses[leaf] += beside
                self.steps[leaf].append(4 * place + len(run))
        self._add(level + 1, node_digest(digests), run[0][1], run[-1][2])

    def close(self, levels: int) -> bytes:
        """Complete what is open below ``levels``, also runs of one; the node that remains."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        ((root, _, _),) = self.open[levels]
        return root


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while ARITY**levels < n:
        levels += 1
    return levels


def fold(digest: bytes, steps: bytes, witness: bytes) -> bytes:
    """The root that a leaf leads to by its witness."""
    at = 0
    for step in steps:
        place, size = divmod(step, 4)
        beside = [witness[at + 32 * k : at + 32 * k + 32] for k in range(size - 1)]
        at += 32 * (size - 1)
        digest = node_digest([*beside[:place], digest, *beside[place:]])
    return digest


def _append(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, digest, ...) with block, witness, steps, and root of the block.

    ``root`` stands on a block's first node alone.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def closed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frontier = Frontier()
        for some in held:
            for digest in some.column("digest").to_pylist():
                frontier.append(digest)
        n = held[0].column("n")[0].as_py()
        root = frontier.close(levels_of(n) if n <= BLOCK else BLOCK_LEVELS)
        at = 0
        for some in held:
            size = some.num_rows
            roots = [root if at + k == 0 else None for k in range(size)]
            columns = [
                pa.array([bytes(w) for w in frontier.witnesses[at : at + size]], pa.binary()),
                pa.array([bytes(s) for s in frontier.steps[at : at + size]], pa.binary()),
                pa.array(roots, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*some.columns, *columns], [*some.schema.names, "witness", "steps", "root"]
            )
            at += size

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        here = None
        for batch in batches:
            keys = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist()))
            start = 0
            for k, key in enumerate(keys):
                if key != here:
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    if held:
                        yield from closed(held)
                    held, here, start = [], key, k
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield from closed(held)

    blocked = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocked.schema)
    return (
        blocked.repartition(parts, "tree", "block")
        .sortWithinPartitions("tree", "block", "pos")
        .mapInArrow(append, f"{types}, witness binary, steps binary, root binary")
    )


def _grow(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with their witness inside their block, and for each block the rest of it.

    The latter are (tree, block, up_witness, up_steps, tree_root).
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    own = stored(_append(nodes), "manifest-nodes")
    firsts = own.where(F.col("root").isNotNull()).select("tree", "block", "n", "root")
    none = F.lit(b"")
    if most <= BLOCK:
        above = firsts.select("tree", "block", none.alias("up_witness"), none.alias("up_steps"), F.col("root").alias("tree_root"))
        return own, above
    parents = firsts.where(F.col("n") > BLOCK).select(
        "tree",
        F.col("block").alias("pos"),
        F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
        F.col("root").alias("digest"),
    )
    higher = _complete(*_grow(parents)).select(
        "tree", F.col("pos").alias("block"), "witness", "steps", "tree_root"
    )
    above = firsts.join(higher, ["tree", "block"], "left").select(
        "tree",
        "block",
        F.coalesce("witness", none).alias("up_witness"),
        F.coalesce("steps", none).alias("up_steps"),
        F.coalesce("tree_root", "root").alias("tree_root"),
    )
    return own, above


def _complete(own: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes with their whole witness and the root of their tree."""
    return (
        own.drop("root")
        .join(above, ["tree", "block"])
        .withColumns({"witness": F.concat("witness", "up_witness"), "steps": F.concat("steps", "up_steps")})
        .drop("up_witness", "up_steps", "block", "n")
    )


def witnesses(leaves: DataFrame) -> DataFrame:
    """``leaves`` with pos, witness, steps, subroot and root.

    ``leaves`` have ``tree`` (not null; trees follow each other in its order), ``digest``
    (binary) and the columns by which they ascend, ``doc_id`` first; others are kept.
    """
    placed = numbered(stored(leaves, "leaves"), ["tree"], ["doc_id", "digest"], "leaves-in-order")
    own, above = _grow(placed)
    above = stored(above, "manifest-blocks")
    # the roots of the trees are the leaves of the tree above, one row of each tree
    tops = above.where(F.col("block") == 0).select(
        F.lit("").alias("tree"), F.col("tree").alias("doc_id"), F.col("tree_root").alias("digest")
    )
    higher = _complete(*_grow(numbered(tops, ["tree"], ["doc_id"], "trees-in-order")))
    higher = stored(
        higher.select(
            F.col("doc_id").alias("tree"), F.col("witness").alias("w"), F.col("steps").alias("s"),
            F.col("tree_root").alias("whole_root"),
        ),
        "manifest-trees",
    )
    # joined to blocks, of which a hot tree has few
    above = above.join(higher, "tree").select(
        "tree",
        "block",
        F.concat("up_witness", "w").alias("up_witness"),
        F.concat("up_steps", "s").alias("up_steps"),
        "tree_root",
        "whole_root",
    )
    return _complete(own, stored(above, "manifest-above")).withColumnsRenamed(
        {"tree_root": "subroot", "whole_root": "root"}
    )


def _folded(proved: DataFrame) -> DataFrame:
    """``proved`` with ``folded``: the root that ``shown`` leads to by the witness."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            triples = zip(*(batch.column(n).to_pylist() for n in ("shown", "steps", "witness")))
            folded = pa.array([fold(*x) for x in triples], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, folded], [*batch.schema.names, "folded"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in proved.schema)
    return proved.mapInArrow(verify, f"{types}, folded binary")


def manifest(docs: DataFrame, shown_text: Column | None = None) -> DataFrame:
    """(doc_id, source, pos, leaf, subroot, root, witness, steps, folded_root, verified) of every row.

    ``shown_text`` is the text that somebody shows as a row's; it is checked against the
    manifest of ``docs``, its own text if not given.
    """
    others = [F.col(c) for c in FIELDS[:-1]]
    leaf = F.unhex(leaf_digest([*others, F.col("text")]))
    shown = leaf if shown_text is None else F.unhex(leaf_digest([*others, shown_text]))
    # a null source is the least tree; others keep their order behind a sign
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf.alias("digest"), shown.alias("shown"))
    text = lambda c: F.lower(F.hex(c))
    return _folded(witnesses(leaves)).select(
        "doc_id",
        F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("source"),
        "pos",
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        "witness",
        "steps",
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op11_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(table(spark, sf_dir, "documents"), shown)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.lower(F.hex("witness")), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


#: The unsigned crc32 of a decimal number, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(
  [[ord(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split({0}::varchar, '')])),
  lambda c, o: case when o >= 0 then xor(c, o)
    else xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end) end))"""

_TREE_SQL = """
{name} as (
  select tree, 0 as level, pos, n, digest from {leaves}
  union all
  select tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from {name} where n > 1 group by tree, level, pos // 3, n),
{name}_paths as (
  select r, tree, 0 as level, pos, n, shown, ''::varchar as proof from {starts}
  union all
  select p.r, p.tree, p.level + 1, p.pos // 3, (p.n + 2) // 3,
    sha256(string_agg(case when t.pos = p.pos then p.shown else t.digest end, '' order by t.pos)),
    p.proof || coalesce(string_agg(case when t.pos <> p.pos then t.digest end, '' order by t.pos), '')
  from {name}_paths p join (select * from {name}_kept) t
    on t.tree = p.tree and t.level = p.level and t.pos // 3 = p.pos // 3
  where p.n > 1 group by p.r, p.tree, p.level, p.pos, p.n, p.shown, p.proof)"""

_FIELD_SQL = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF_SQL = "sha256({} || {})".format(" || ".join(_FIELD_SQL.format(c) for c in FIELDS[:-1]), "{}")


def _tree_sql(name: str, leaves: str, starts: str) -> str:
    nodes, paths = _TREE_SQL.format(name=name, leaves=leaves, starts=starts).split(f",\n{name}_paths as")
    return f"{nodes},\n{name}_kept as materialized (select * from {name}),\n{name}_paths as{paths}"


OP11_SQL = f"""
with recursive leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as pos,
    count(*) over (partition by tree) as n
  from (
    select row_number() over () as r, coalesce('=' || source, '') as tree, doc_id,
      {_LEAF_SQL.format(_FIELD_SQL.format("text"))} as digest,
      case when {CRC32_SQL.format("doc_id")} % 2 = 0
        then {_LEAF_SQL.format(_FIELD_SQL.format("replace(text, chr(10), '')"))}
        else {_LEAF_SQL.format(_FIELD_SQL.format("text"))} end as shown
    from documents)),
{_tree_sql("own", "leaves", "leaves")},
tops as (
  select '' as tree, tree as source, row_number() over (order by tree) - 1 as pos, count(*) over () as n, digest
  from own_kept where n = 1),
carried as (
  select p.r, t.tree, t.pos, t.n, p.shown from own_paths p join tops t on t.source = p.tree where p.n = 1),
{_tree_sql("top", "tops", "carried")}
select doc_id, l.digest as leaf, t.digest as subroot, (select digest from top_kept where n = 1) as root,
  sha256(p.proof || u.proof) as proof_sha256, u.shown as folded_root,
  u.shown = (select digest from top_kept where n = 1) as verified
from leaves l
join own_paths p on p.r = l.r and p.n = 1
join top_paths u on u.r = l.r and u.n = 1
join tops t on t.source = l.tree
"""
