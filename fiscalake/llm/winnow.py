"""Document fingerprints by winnowing.

A rolling hash gives the hash of every run of ``GRAM`` code points; of every ``WINDOW``
successive hashes the least is chosen, of equal ones the rightmost. The chosen hashes with
their positions are the fingerprint. Two texts that share a run of ``WINDOW + GRAM - 1``
code points share a chosen hash, and the positions tell where.

``follow`` pairs each document with the one that follows it. Documents are dealt to ranges
of ids and sorted there; the text that follows a range's last document is fetched by its id
and travels with the range. Texts are shuffled once. An id with more rows than a range gets
tasks of its own, which share its rows evenly.

Cases: a null text is empty and has no fingerprint; a text of fewer code points than a
gram, but not none, is one gram; two empty fingerprints have likeness 1, an empty and
another one 0; rows of one id have the same next document, and where several rows have the
next id, the text with the least hash is taken; a null id counts as the least; a single
id follows itself; repeated rows are returned each; texts of any length are
fingerprinted whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import lean, table, text_slices
from fiscalake.llm.shards import longs, range_of

#: Code points of a gram, hashes of a window.
GRAM, WINDOW = 12, 16
#: Ranges of ids for each shuffle partition.
RANGES = 4
SLICE_BYTES = 1_000_000

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


class Winnower:
    """Fingerprints of texts; keeps the powers of the rolling hash."""

    def __init__(self, gram: int = GRAM, window: int = WINDOW):
        self.gram, self.window = gram, window
        self._extend(4096)

    def _extend(self, n: int) -> None:
        ones = np.ones(1, dtype=np.uint64)
        grown = lambda base: np.concatenate([ones, np.cumprod(np.full(n, base, dtype=np.uint64))])
        self.powers, self.inverses = grown(_BASE), grown(_INVERSE)

    def hashes(self, points: np.ndarray) -> np.ndarray:
        """A 32-bit hash of every gram, from prefix sums: each one takes the same few steps."""
        n = len(points)
        if not n:
            return np.empty(0, dtype=np.uint32)
        if n >= len(self.powers):
            self._extend(2 * n)
        width = min(self.gram, n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        count = n - width + 1
        rolled = (sums[width:] - sums[:count]) * self.inverses[:count] + np.uint64(width)
        rolled ^= rolled >> np.uint64(32)
        rolled *= _MIX[0]
        rolled ^= rolled >> np.uint64(29)
        rolled *= _MIX[1]
        return (rolled >> np.uint64(32)).astype(np.uint32)

    def choose(self, hashes: np.ndarray) -> np.ndarray:
        """Positions that windows choose, ascending; fewer hashes than a window are one."""
        n = len(hashes)
        if not n:
            return np.empty(0, dtype=np.int64)
        width = min(self.window, n)
        # hash, then the later position, in one number: windows double until they are wide enough
        order = (hashes.astype(np.uint64) << np.uint64(32)) | np.arange(0xFFFFFFFF, 0xFFFFFFFF - n, -1, dtype=np.uint64)
        held = 1
        while held < width:
            step = min(held, width - held)
            order = np.minimum(order[:-step], order[step:])
            held += step
        return np.unique(0xFFFFFFFF - (order & np.uint64(0xFFFFFFFF)).astype(np.int64))

    def fingerprint(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, positions) that are chosen, by position."""
        every = self.hashes(points)
        at = self.choose(every)
        return every[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints that both have."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def spelled(hashes: np.ndarray, positions: np.ndarray) -> str:
    """hash:position,... with hashes in hex."""
    return ",".join([f"{h:08x}:{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) of every row of ``docs`` (doc_id, text)."""

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(gram, window)
        for batch in batches:
            for a, b in text_slices(batch.column("text"), SLICE_BYTES):
                some = batch.slice(a, b - a)
                found = [winnower.fingerprint(code_points(t or "")) for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": some.column("doc_id"),
                        "hashes": pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                        "positions": pa.array([p for _, p in found], pa.list_(pa.int64())),
                    }
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lean(winnow), f"doc_id {key}, hashes array<bigint>, positions array<bigint>"
    )


def _bounds(docs: DataFrame, ranges: int) -> list[int]:
    """Ids that begin a range; an id that fills more than a range has one of its own."""
    steps = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("key", steps, 100 * ranges).alias("q")).first()["q"] or []
    hot = {a for a, b in zip(found, found[1:]) if a == b}
    return sorted({*found, *(key + 1 for key in hot)})


def follow(docs: DataFrame) -> DataFrame:
    """Rows (range, deal, role, key, doc_id, order, text), of which role 1 is ``docs``.

    In each (range, deal), sorted by role, key and order, the document that follows another one
    (by descending id; the first after the last) has the next lower key, or role 0. ``deal``
    tells the equal parts of a hot id's range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"), text.alias("text")
    )
    bounds = _bounds(keyed, RANGES * parts)
    ranged = keyed.withColumn("range", range_of(F.col("key"), bounds))
    # one row for each range: fewer than RANGES * parts plus the hot ids
    held = sorted(
        ranged.groupBy("range")
        .agg(F.max("key").alias("most"), F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
        .collect(),
        key=lambda r: r["range"],
    )
    rows = max(1, sum(r["n"] for r in held))
    deals = {
        r["range"]: max(1, round(r["n"] * len(held) / rows)) if r["most"] == r["least"] else 1 for r in held
    }
    listed = [deals.get(k, 1) for k in range(len(bounds) + 1)]
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(longs(listed), F.col("range")))
    own = ranged.select(
        "range", deal.alias("deal"), F.lit(1).alias("role"), "key", "doc_id", F.xxhash64("text").alias("order"), "text"
    )
    # the text that follows each range is that of the greatest key before it
    wanted = spark.createDataFrame(
        [(r["range"], d, held[k - 1]["most"]) for k, r in enumerate(held) for d in range(deals[r["range"]])],
        "range int, deal bigint, key bigint",
    )
    first = keyed.join(F.broadcast(wanted.select("key").distinct()), "key")
    heads = first.groupBy("key").agg(F.min(F.struct(F.xxhash64("text").alias("order"), "text")).alias("o"))
    ahead = wanted.join(heads, "key").select(
        "range", "deal", F.lit(0).alias("role"), "key",
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "o.order", "o.text",
    )
    return own.unionByName(ahead)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters of ``following``, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its own, its edited and its next text's fingerprint.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(gram, window)
        whole = lambda t: winnower.fingerprint(code_points(t))
        # the document that follows, and the first one of the key that is read
        here = key = after = current = None
        for batch in batches:
            for a, b in text_slices(batch.column("text"), SLICE_BYTES):
                some = batch.slice(a, b - a)
                out, taken = [], []
                names = ("range", "deal", "role", "key", "text")
                for k, (part, deal, role, own_key, text) in enumerate(zip(*(some.column(n).to_pylist() for n in names))):
                    own = whole(text)
                    if (part, deal) != here:
                        here, key, current = (part, deal), None, (text, own[0])
                        if role == 0:
                            continue
                    if own_key != key:
                        key, after, current = own_key, current, (text, own[0])
                    changed = edited(text, after[0])
                    other = whole(changed)
                    taken.append(k)
                    out.append(
                        (
                            len(text), hashlib.sha256(changed.encode()).hexdigest(), spelled(*own), spelled(*other),
                            likeness(own[0], other[0]), likeness(own[0], after[1]),
                        )
                    )
                columns = list(zip(*out)) if out else [()] * 6
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(pa.array(taken, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (
        follow(docs)
        .repartition(parts, "range", "deal")
        .sortWithinPartitions("range", "deal", "role", "key", "order")
        .mapInArrow(
            lean(compare),
            f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
