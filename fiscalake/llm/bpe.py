"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece's tree holds, for every live position, the rank of the pair that starts there; an
inner node holds the leftmost minimum of its children. A merge takes the root, joins two
live neighbours and updates the two pairs it touches, each along one path of the tree:
n pieces of text merge in O(n log n). Many short pieces of about the same length are merged
side by side, one numpy lane each; long pieces walk their own tree.

Pieces recur, so every worker keeps the tables and the ids of the pieces it has met over all
its tasks, up to a fixed number of bytes; long pieces are not kept. Texts are encoded in
slices of bounded bytes, whatever the size of a batch. Nothing is shuffled; the rank file
(about a megabyte) travels in the closure.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded
each; texts of any length are encoded whole; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from fiscalake.llm.common import lean, table, text_slices

#: No pair starts here.
NONE = np.int32(2**31 - 1)
#: Pieces of up to so many bytes are merged side by side.
LANE_BYTES = 64
#: Bytes of pieces and ids that a worker remembers, and what one costs besides.
MEMORY, COST = 40_000_000, 200
#: Bytes of texts that are encoded together, and pieces that are merged together.
SLICE_BYTES, LANES = 500_000, 5_000


def rank_table(content: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from the lines of a rank file."""
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in content.splitlines() if line.strip())
    }


class PairRanks:
    """Ids of byte strings, and the rank of each pair of ids that merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.size = max(self.tokens) + 1
        self.merge: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merge[left * self.size + right] = rank
        keys = np.fromiter(self.merge, dtype=np.int64, count=len(self.merge))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.fromiter(self.merge.values(), dtype=np.int32, count=len(keys))[order]

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NONE`` where a side is missing (-1) or nothing merges."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.values[at], NONE)


def merge_lanes(pieces: list[bytes], pairs: PairRanks) -> list[list[int]]:
    """Ids of pieces of similar length: one tree for each row of the arrays."""
    rows, lengths = len(pieces), np.array([len(p) for p in pieces])
    width = 1 << max(0, int(lengths.max()) - 1).bit_length()
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
    place = np.arange(width)
    ids = np.where(place < lengths[:, None], pairs.bytes[raw.reshape(rows, width)], -1)
    after = np.broadcast_to(place + 1, (rows, width)).copy()
    before = np.broadcast_to(place - 1, (rows, width)).copy()
    right = np.concatenate([ids[:, 1:], np.full((rows, 1), -1)], axis=1)
    # node k has children 2k and 2k+1; leaves are width .. 2 width - 1
    least = np.full((rows, 2 * width), NONE, dtype=np.int32)
    where = np.zeros((rows, 2 * width), dtype=np.int32)
    least[:, width:] = pairs.of(ids.ravel(), right.ravel()).reshape(rows, width)
    where[:, width:] = place
    for k in range(width - 1, 0, -1):
        take = least[:, 2 * k] <= least[:, 2 * k + 1]
        least[:, k] = np.where(take, least[:, 2 * k], least[:, 2 * k + 1])
        where[:, k] = np.where(take, where[:, 2 * k], where[:, 2 * k + 1])

    def update(row, leaf, rank):
        node = leaf + width
        least[row, node] = rank
        while width > 1 and node[0] > 1:  # all leaves are on one level
            node = node >> 1
            a, b = least[row, 2 * node], least[row, 2 * node + 1]
            take = a <= b
            least[row, node] = np.where(take, a, b)
            where[row, node] = np.where(take, where[row, 2 * node], where[row, 2 * node + 1])

    live = np.flatnonzero(least[:, 1] != NONE)
    while len(live):
        at = where[live, 1]
        gone = after[live, at]
        ids[live, at] = least[live, 1]
        follow = after[live, gone]
        after[live, at] = follow
        inside = follow < width
        before[live[inside], follow[inside]] = at[inside]
        ids[live, gone] = -1
        nobody = np.full(len(live), NONE, dtype=np.int32)
        update(live, gone, nobody)
        ahead = np.where(inside, ids[live, np.minimum(follow, width - 1)], -1)
        update(live, at, pairs.of(ids[live, at], ahead))
        back = before[live, at]
        has = back >= 0
        if has.any():
            row, b = live[has], back[has]
            update(row, b, pairs.of(ids[row, b], ids[row, at[has]]))
        live = live[least[live, 1] != NONE]
    held = ids >= 0
    ends = np.cumsum(held.sum(axis=1)).tolist()
    flat = ids[held].tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def merge_long(piece: bytes, pairs: PairRanks) -> list[int]:
    """Ids of one piece of any length."""
    n = len(piece)
    width = 1 << max(1, (n - 1).bit_length())
    ids = pairs.bytes[np.frombuffer(piece, dtype=np.uint8)]
    none = int(NONE)
    first = np.full(width, NONE, dtype=np.int64)
    first[: n - 1] = pairs.of(ids[:-1], ids[1:])
    # the rank and the position in one number: the least is the leftmost minimum
    levels = [first * width + np.arange(width)]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = array("q", np.concatenate([[0], *reversed(levels)]).astype(np.int64).tobytes())
    ids, merge, size = array("q", ids.tobytes()), pairs.merge, pairs.size
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))

    def update(leaf, rank):
        node = leaf + width
        tree[node] = rank * width + leaf
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a < b else b
            if tree[node] == best:
                break
            tree[node] = best

    while tree[1] < none * width:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        follow = after[gone]
        ids[at], ids[gone], after[at] = rank, -1, follow
        update(gone, none)
        if follow < n:
            before[follow] = at
            update(at, merge.get(rank * size + ids[follow], none))
        else:
            update(at, none)
        back = before[at]
        if back >= 0:
            update(back, merge.get(ids[back] * size + rank, none))
    return [i for i in ids if i >= 0]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts to ids and back; remembers pieces."""

    def __init__(self, content: bytes, pattern: str):
        # \s as the reference library reads it: Unicode's White_Space
        self.pattern = regex.compile(pattern)
        self.ranks = rank_table(content)
        self.pairs = PairRanks(self.ranks)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of new pieces; those of up to LANE_BYTES are remembered while there is room."""
        new: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            rank = self.ranks.get(raw)
            if rank is not None:
                new[piece] = _packed([rank])
            elif len(raw) > LANE_BYTES:
                new[piece] = _packed(merge_long(raw, self.pairs))
            else:
                by_width.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in by_width.values():
            for k in range(0, len(group), LANES):
                some = group[k : k + LANES]
                for (piece, _), ids in zip(some, merge_lanes([raw for _, raw in some], self.pairs)):
                    new[piece] = _packed(ids)
        for piece, ids in new.items():
            if self.held < MEMORY and len(piece) <= LANE_BYTES:
                self.known[piece] = ids
                self.held += len(piece) + len(ids) + COST
        return new

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [self.pattern.findall(text) for text in texts]
        new = self._learn(set().union(*split).difference(self.known))
        known = self.known
        for pieces in split:
            packed = b"".join([known[p] if p in known else new[p] for p in pieces])
            yield np.frombuffer(packed, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pairs.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def _shared_encoder(content: bytes, pattern: str) -> Encoder:
    """One for each Python process: Spark's workers run many tasks."""
    return Encoder(content, pattern)


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit integers. The file is read where the plan is
    made, never by executors.
    """
    content = read_bytes(rank_path)
    key = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _shared_encoder(content, pattern)
        for batch in batches:
            for start, end in text_slices(batch.column("text"), SLICE_BYTES):
                some = batch.slice(start, end - start)
                counts, ids_hash, text_hash, raw = [], [], [], []
                for ids in encoder.encode([t or "" for t in some.column("text").to_pylist()]):
                    packed = ids.tobytes()
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(packed).hexdigest())
                    text_hash.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                    if with_ids:
                        raw.append(packed)
                columns = {
                    "doc_id": some.column("doc_id"),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(ids_hash, pa.string()),
                    "decoded_sha256": pa.array(text_hash, pa.string()),
                }
                if with_ids:
                    columns["ids"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {key}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(lean(encode), schema)


def decode_ids(encoded: DataFrame, rank_path: str) -> DataFrame:
    """(doc_id, text) from rows with ``ids`` as :func:`encode_documents` gives them."""
    content = read_bytes(rank_path)
    key = encoded.schema["doc_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in rank_table(content).items()}
        for batch in batches:
            texts = [
                b"".join(map(tokens.__getitem__, np.frombuffer(raw or b"", "<u4").tolist())).decode("utf-8")
                for raw in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())}
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {key}, text string")


def op5_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
