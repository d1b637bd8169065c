"""Near-duplicate detection with MinHash.

1. Every text gets the minima of many universal hashes over its word shingles, the keys of
   its bands of minima, and a digest of its shingle set. Equal sets are one class.
2. Classes that share a band key meet in a bucket. The member that meets most others leads
   the bucket and is compared with every member: as many pairs as members.
3. Pairs pass by their signatures, then by their full sets; passing pairs are links, and
   components come from large-star and small-star steps.
4. Similarity is not transitive, so a leader can miss links between two other members. Every
   bucket in which different components are left is searched for those links: members
   outside its main component against all members, in blocks, by signature, then by set.

At a similarity of 0.8 a pair has no common key with a chance of 6e-7, and a signature
that hides it (a share of equal minima below 0.65) with one of 1e-6.

Cases: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text of fewer words than a shingle is one shingle; rows of one id are one
document, whose texts all count; a row without an id is in no group and kept; repeated
rows are returned each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import UPPER, lean, stored, table, text_slices
from fiscalake.llm.components import connected_components

#: Linked from this similarity, in hundredths.
SIMILARITY = 80
BANDS, ROWS = 36, 5
#: Least share of equal minima of a pair that is compared in full.
SIGNATURE_SHARE = 0.65
#: Members of a block in the search of step 4.
BLOCK = 128
#: Words a task remembers the hashes of, and bytes of texts that are hashed together.
MEMORY, SLICE_BYTES = 100_000, 1_000_000
SEED = 7

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of the distinct word shingles of texts."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [(text or "").encode("utf-8").translate(_LOWER).split() for text in texts]
        if len(self.known) > MEMORY:
            self.known = {}
        for word in set().union(*split).difference(self.known):
            self.known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        hashed = [np.fromiter(map(self.known.__getitem__, ws), np.uint64, len(ws)) for ws in split]
        return [self._shingles(h) for h in hashed]

    def _shingles(self, hashed: np.ndarray) -> np.ndarray:
        n = min(self.words, len(hashed))
        if not n:
            return hashed
        count = len(hashed) - n + 1
        value = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            value = _mixed(value * _ODD[0] + hashed[k : k + count])
        return np.unique(value)


def similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    """Whether the intersection has ``similarity`` hundredths of the union; empty sets never."""
    if 100 * min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= similarity * (len(a) + len(b) - common)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of BANDS * ROWS universal hashes, a row for each set; no set may be empty."""
    draw = np.random.default_rng(SEED)
    factors = draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint64)
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (end == start or held + len(sets[end]) <= 60_000):
            held += len(sets[end])
            end += 1
        x = np.concatenate(sets[start:end])
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets[start : end - 1]], dtype=np.int64)]).astype(np.int64)
        t = np.empty_like(x)
        for j in range(BANDS * ROWS):
            np.multiply(x, factors[j], out=t)
            np.add(t, shifts[j], out=t)
            out[start:end, j] = np.minimum.reduceat(t, first)
        start = end
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    keys = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(minima), 1), dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _ODD[0] + minima[:, k::ROWS])
    return keys.view(np.int64)


def _sketch(docs: DataFrame, words: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for a, b in text_slices(batch.column("text"), SLICE_BYTES):
                sets = shingler.sets(batch.column("text").slice(a, b - a).to_pylist())
                full = [k for k, s in enumerate(sets) if len(s)]
                digests = [hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest() for k in full]
                minima = signatures([sets[k] for k in full])
                brief = (_mixed(minima) >> np.uint64(48)).astype(np.uint16).view(np.int16)
                at = dict(zip(full, zip(digests, band_keys(minima), brief)))
                columns = [at.get(k, (None, None, None)) for k in range(len(sets))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(a, len(sets)),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array([c[0] for c in columns], pa.binary()),
                        "bands": pa.array([c[1] for c in columns], pa.list_(pa.int64())),
                        "minima": pa.array([c[2] for c in columns], pa.list_(pa.int16())),
                    }
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lean(sketch),
        f"doc_id {key}, n_shingles bigint, digest binary, bands array<bigint>, minima array<smallint>",
    )


def _leader_pairs(hits: DataFrame) -> DataFrame:
    """(x, y): the leader of each bucket and every other member."""
    sizes = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weight = hits.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("weight"))
    weighted = hits.join(weight, "id")
    leaders = weighted.groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("x"))
    return (
        hits.join(leaders, "key").where(F.col("x") != F.col("id")).select("x", F.col("id").alias("y")).distinct()
    )


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in enough places."""
    minima = classes.select(F.col("doc_id").alias("id"), "minima")
    both = pairs.join(minima.select(F.col("id").alias("y"), F.col("minima").alias("my")), "y").join(
        minima.select(F.col("id").alias("x"), F.col("minima").alias("mx")), "x"
    )
    equal = F.size(F.filter(F.zip_with("mx", "my", lambda a, b: a == b), lambda same: same))
    return both.where(equal >= int(SIGNATURE_SHARE * BANDS * ROWS)).select("x", "y").distinct()


def _linked(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Pairs (x, y) whose full sets are similar enough.

    The members of a star are dealt out in as many parts as there are shuffle partitions
    at most; the centre's text goes to each part that has members.
    """
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("y"), F.lit(parts)))
    wanted = (
        dealt.select("x", "part").distinct().select("x", "part", F.lit(0).alias("role"), F.col("x").alias("id"))
    ).union(dealt.select("x", "part", F.lit(1).alias("role"), F.col("y").alias("id")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        centre, own = None, []
        for batch in batches:
            names = ["x", "part", "role", "id", "text"]
            found_x, found_y = [], []
            for a, b in text_slices(batch.column("text"), SLICE_BYTES):
                columns = [batch.column(n).slice(a, b - a).to_pylist() for n in names]
                for x, part, role, y, found in zip(*columns[:4], shingler.sets(columns[4])):
                    if role == 0:
                        own = [*own, found] if centre == (x, part) else [found]
                        centre = (x, part)
                        continue
                    if any(similar(s, found, similarity) for s in own):
                        found_x.append(x)
                        found_y.append(y)
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(found_x, batch.column("x").type), "y": pa.array(found_y, batch.column("x").type)}
            )

    key = pairs.schema["x"].dataType.simpleString()
    rows = wanted.join(texts, "id").select("x", "part", "role", "id", "text")
    return (
        rows.repartition(parts, "x", "part")
        .sortWithinPartitions("x", "part", "role")
        .mapInArrow(lean(compare), f"x {key}, y {key}")
    )


class _Block:
    """Rows of one block of a bucket: side 0 against side 1."""

    def __init__(self, rows: list[dict]):
        self.sides = [[r for r in rows if r["side"] == side] for side in (0, 1)]
        self.band = rows[0]["band"]

    def _matrix(self, name: str, kind) -> list[np.ndarray]:
        return [np.array([r[name] for r in side], dtype=kind).reshape(len(side), -1) for side in self.sides]

    def links(self, shingler: Shingler, similarity: int) -> Iterator[tuple]:
        """Links between different components, one for each pair of components at most.

        A pair that meets in an earlier band as well is left to that band's bucket.
        """
        outside, inside = self.sides
        if not outside or not inside:
            return
        a, b = self._matrix("minima", np.int16)
        equal = np.zeros((len(a), len(b)), dtype=np.int16)
        for j in range(a.shape[1]):
            equal += a[:, j][:, None] == b[:, j][None, :]
        c, d = self._matrix("bands", np.int64)
        earlier = np.zeros(equal.shape, dtype=bool)
        for j in range(self.band):
            earlier |= c[:, j][:, None] == d[:, j][None, :]
        likely = np.argwhere((equal >= int(SIGNATURE_SHARE * BANDS * ROWS)) & ~earlier)
        likely = likely[np.argsort(-equal[likely[:, 0], likely[:, 1]], kind="stable")]
        name: dict = {}
        sets: dict = {}

        def root(label):
            while name.get(label, label) != label:
                label = name[label]
            return label

        def full(side: int, k: int) -> np.ndarray:
            if (side, k) not in sets:
                (sets[side, k],) = shingler.sets([self.sides[side][k]["text"]])
            return sets[side, k]

        for i, k in likely.tolist():
            x, y = root(outside[i]["label"]), root(inside[k]["label"])
            if x != y and similar(full(0, i), full(1, k), similarity):
                name[x] = y
                yield outside[i]["id"], inside[k]["id"]


def _missed_links(
    hits: DataFrame, labels: DataFrame, members: DataFrame, words: int, similarity: int
) -> DataFrame:
    """(x, y) that join different components of a bucket and that no leader has seen.

    In blocks: the members outside the bucket's main component against all members. Pairs
    are compared where they meet; what comes out joins components.
    """
    spark = hits.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labelled = hits.join(labels, "id", "left").select(
        "key", "band", "id", F.coalesce("component", "id").alias("label")
    )
    groups = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        groups.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("kinds"),
            F.sum("n").alias("n"),
            F.max_by("label", F.struct("n", "label")).alias("main"),
            F.max("n").alias("n_main"),
        )
        .where((F.col("kinds") > 1) & (F.col("n") > 2))
    )
    found = (
        labelled.join(mixed, "key")
        .select(
            "key", "band", "id", "label", (F.col("label") != F.col("main")).alias("outside"),
            F.ceil((F.col("n") - F.col("n_main")) / BLOCK).alias("outer"),
            F.ceil(F.col("n") / BLOCK).alias("inner"),
        )
        .join(members, "id")
    )
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    place = lambda side, o, i: F.struct(F.lit(side).alias("side"), o.alias("o"), i.alias("i"))
    as_outside = F.transform(upto("inner"), lambda i: place(0, own("outer"), i))
    as_member = F.transform(upto("outer"), lambda o: place(1, o, own("inner")))
    places = F.when(F.col("outside"), F.concat(as_outside, as_member)).otherwise(as_member)
    dealt = found.select("key", "band", "id", "label", "minima", "bands", "text", F.inline(places))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, here, id_type = Shingler(words), [], None, None

        def out(links: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"x": pa.array([x for x, _ in links], id_type), "y": pa.array([y for _, y in links], id_type)}
            )

        for batch in batches:
            id_type = batch.column("id").type
            for k in range(0, batch.num_rows, 500):
                for row in batch.slice(k, 500).to_pylist():
                    block = (row["key"], row["o"], row["i"])
                    if held and block != here:
                        yield out(list(_Block(held).links(shingler, similarity)))
                        held = []
                    here = block
                    held.append(row)
        if held:
            yield out(list(_Block(held).links(shingler, similarity)))

    key = hits.schema["id"].dataType.simpleString()
    return (
        dealt.repartition(parts, "key", "o", "i")
        .sortWithinPartitions("key", "o", "i")
        .mapInArrow(lean(compare), f"x {key}, y {key}")
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id that is reached over links, ``doc_id`` is an integer.
    """
    sketched = stored(_sketch(docs, shingle_words), "sketch")
    named = sketched.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    first = stored(named.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    classes = stored(
        named.join(first, "digest").where(F.col("doc_id") == F.col("class_id")).select("doc_id", "bands", "minima"),
        "sketch-of-classes",
    )
    meet = classes.select(F.posexplode("bands").alias("band", "key"), F.col("doc_id").alias("id")).distinct()
    shared = meet.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    hits = stored(meet.join(shared, "key"), "buckets")
    met = hits.select("id").distinct()
    texts = stored(docs.select(F.col("doc_id").alias("id"), "text").join(met, "id", "left_semi"), "texts")
    pairs = stored(_agreeing(_leader_pairs(hits), classes), "pairs")
    links = stored(_linked(pairs, texts, shingle_words, similarity), "links")
    labels = stored(connected_components(links), "labels")
    members = texts.join(classes.withColumnRenamed("doc_id", "id"), "id")
    more = _missed_links(hits, labels, members, shingle_words, similarity)
    whole = labels.select(F.col("id").alias("x"), F.col("component").alias("y")).union(more)
    final = connected_components(whole).select(F.col("id").alias("class_id"), "component")
    named_classes = stored(
        first.join(final, "class_id", "left").select("digest", F.coalesce("component", "class_id").alias("component_id")),
        "components",
    )
    return (
        sketched.select("doc_id", "n_shingles", "digest")
        .join(named_classes, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)
