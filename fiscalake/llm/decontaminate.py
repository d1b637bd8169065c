"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a bounded slice of a task's rows. Its words become symbols, the last column of
its sorted suffixes goes into a wavelet matrix, and all phrases of the benchmark are
searched backwards side by side. Their occurrences are located by walking to the next
sampled suffix, merged to spans of words, and counted for each document.

Words that no phrase has are one symbol, and stretches of other words shorter than the
shortest phrase cannot hold an occurrence: neither costs space in the index.

The benchmark reaches the tasks in blocks of bounded size. A usual benchmark is one block:
rows pass by once and nothing is shuffled. Of a larger one, every block reads the documents
again and leaves its hits, one row for each text that has any; the documents are not written.

Cases: a null or empty text has no words, hits or items and is not contaminated; so has
one of punctuation only; items without an id or without words are left out; an item
shorter than a window is one window; several rows of an item id are one item; repeated
documents are judged each; an empty benchmark leaves all clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalake.llm.common import lean, stored, table, text_slices

WINDOW = 13
#: Contaminated from one hit word in so many.
HIT_SHARE = 20
#: Bytes of benchmark text in a block, and of training text in a shard.
BLOCK_BYTES, SHARD_BYTES = 16_000_000, 4_000_000
#: Every so many positions of the text keep their suffix.
SAMPLE = 16

# Symbols: the end of the text, then words of no phrase and gaps, then the words of phrases.
END, OTHER, FIRST_WORD = 0, 1, 2

#: Bytes of words stay (A-Z in lower case), all others become spaces.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


class Phrases:
    """Windows of a block of items, as rows of symbols filled up with -1 on the left."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + FIRST_WORD) for w in words_of(text)]
            for start in range(max(1, len(symbols) - window + 1) if symbols else 0):
                found.setdefault(tuple(symbols[start : start + window]), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(x) for x in found], dtype=np.int64)
        self.rows = np.full((len(found), window), -1, dtype=np.int64)
        for k, symbols in enumerate(found):
            self.rows[k, window - len(symbols) :] = symbols
        self.shortest = int(self.lengths.min()) if found else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the sorted suffixes, by doubling; the last symbol is the only least one."""
    n = len(text)
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        if step < n:
            following[:-step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbols on each level."""

    def __init__(self, sequence: np.ndarray):
        self.bits = max(1, int(sequence.max()).bit_length())
        self.zeros_before, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (sequence >> level) & 1
            before = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.zeros_before.append(before)
            self.zeros.append(int(before[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        start = np.zeros_like(end)
        for k, (before, zeros) in enumerate(zip(self.zeros_before, self.zeros)):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            start = np.where(one, zeros + start - before[start], before[start])
            end = np.where(one, zeros + end - before[end], before[end])
        return end - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros_like(at)
        for before, zeros in zip(self.zeros_before, self.zeros):
            one = before[at + 1] == before[at]
            value = value * 2 + one
            at = np.where(one, zeros + at - before[at], before[at])
        return value


class FmIndex:
    """Index of one shard; its text ends with the only ``END``."""

    def __init__(self, text: np.ndarray):
        suffixes = suffix_array(text)
        self.n = len(text)
        self.last = WaveletMatrix(text[suffixes - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        sampled = suffixes % SAMPLE == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = suffixes[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the sorted suffixes that start with each phrase."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        width = phrases.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbol = phrases[live, width - back]
            here = symbol < len(self.first) - 1
            low[live[~here]] = high[live[~here]] = 0
            live, symbol = live[here], symbol[here]
            base = self.first[symbol]
            low[live] = base + self.last.rank(symbol, low[live])
            high[live] = base + self.last.rank(symbol, high[live])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions in the text of rows of the sorted suffixes."""
        at, steps = row.copy(), np.zeros(len(row), dtype=np.int64)
        walking = np.arange(len(row))
        while len(walking):
            here = at[walking]
            walking = walking[self.sampled_before[here + 1] == self.sampled_before[here]]
            symbol = self.last.symbol(at[walking])
            at[walking] = self.first[symbol] + self.last.rank(symbol, at[walking])
            steps[walking] += 1
        return self.samples[self.sampled_before[at]] + steps


def search_shard(texts: list[str | None], phrases: Phrases) -> tuple[list[int], list[list[int]], list[set[str]]]:
    """For each text its number of words, its hit spans [start, end, ...] and its items."""
    counts, coded = [], []
    for text in texts:
        found = words_of(text)
        counts.append(len(found))
        coded.append(np.fromiter(map(phrases.vocabulary.get, found, repeat(OTHER)), np.int64, len(found)))
        coded.append(np.array([OTHER]))
    spans: list[list[int]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not len(phrases.lengths):
        return counts, spans, items
    symbols = np.concatenate(coded)
    first = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
    # stretches of phrase words that are long enough, each with one gap after it
    edge = np.flatnonzero(np.diff(np.concatenate([[0], symbols != OTHER, [0]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    long_enough = ends - starts >= phrases.shortest
    starts, sizes = starts[long_enough], (ends - starts)[long_enough] + 1
    if not len(starts):
        return counts, spans, items
    place = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    index = FmIndex(np.append(symbols[place], END))
    low, high = index.search(phrases.rows, phrases.lengths)
    hits = high - low
    phrase = np.repeat(np.arange(len(hits)), hits)
    row = np.arange(hits.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(hits)[:-1]]), hits)
    at = place[index.locate(row)]
    doc = np.searchsorted(first, at, side="right") - 1
    for d, p in np.unique(np.stack([doc, phrase]), axis=1).T.tolist():
        items[d].update(phrases.items[p])
    covered = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + phrases.lengths[phrase], -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(covered) > 0, [0]]).astype(np.int8)))
    for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        d = int(np.searchsorted(first, start, side="right")) - 1
        spans[d] += [start - int(first[d]), end - int(first[d])]
    return counts, spans, items


def merged(spans: list[int]) -> list[int]:
    """Overlapping or touching spans joined."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.StructArray]:
    """The rows in arrays of about SHARD_BYTES of text, however large Spark's batches are."""
    held: list[pa.StructArray] = []
    size = 0
    for batch in batches:
        rows = batch.column("row")
        for a, b in text_slices(rows.field("text"), SHARD_BYTES):
            held.append(rows.slice(a, b - a))
            size += pc.sum(pc.binary_length(rows.field("text").slice(a, b - a))).as_py() or 0
            if size >= SHARD_BYTES:
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def _search(docs: DataFrame, items: list[tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """(row, digest, n_words, spans, items): each row of ``docs`` with its hits.

    ``row`` holds the columns in ``keep``, so no name can clash with another; ``digest`` is the text's.
    """
    fields = [docs.schema[name] for name in keep]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(items)
        for rows in _shards(batches):
            columns = dict(zip([f.name for f in rows.type], rows.flatten()))
            texts = columns["text"].to_pylist()
            counts, spans, found = search_shard(texts, phrases)
            digests = [hashlib.sha256((t or "").encode()).digest() for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.StructArray.from_arrays([columns[n] for n in keep], list(keep)),
                    "digest": pa.array(digests, pa.binary()),
                    "n_words": pa.array(counts, pa.int64()),
                    "spans": pa.array([merged(x) for x in spans], pa.list_(pa.int64())),
                    "items": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                }
            )

    schema = T.StructType(
        [
            T.StructField("row", T.StructType(fields)),
            T.StructField("digest", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(T.LongType())),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    columns = list(dict.fromkeys([*keep, "text"]))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    return docs.select(whole.alias("row")).mapInArrow(lean(search), schema)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )


def _block(items: DataFrame, k: int, n: int) -> list[tuple[str, str]]:
    """The items of one of ``n`` blocks; about ``block_bytes`` each."""
    chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
    return [(r["item_id"], r["text"]) for r in chosen.toLocalIterator()]


def _merged(spans: Column) -> Column:
    """Spans [start, end, ...] of several blocks, sorted, those that overlap or touch joined."""
    ends = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(spans) / 2).cast("int") - 1),
        lambda k: F.struct(F.get(spans, 2 * k).alias("s"), F.get(spans, 2 * k + 1).alias("e")),
    )
    add = lambda done, x: F.when(
        (F.size(done) > 0) & (x["s"] <= F.element_at(done, -1)),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.greatest(F.element_at(done, -1), x["e"]))),
    ).otherwise(F.concat(done, F.array(x["s"], x["e"])))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(spans) == 0, none).otherwise(F.aggregate(F.array_sort(ends), none, add))


def _search_blocks(docs: DataFrame, items: DataFrame, n: int, keep: Sequence[str]) -> DataFrame:
    """As :func:`_search`, for a benchmark of several blocks.

    Every block reads the documents again and leaves only its hits, one for each text that has
    any; texts are not written. The driver holds one block at a time.
    """
    hits = None
    for k in range(n):
        found = _search(docs, _block(items, k, n), ["doc_id"]).where(F.size("items") > 0)
        own = stored(found.select("digest", "spans", "items").dropDuplicates(["digest"]), "hits")
        hits = own if hits is None else hits.unionByName(own)
    joined = hits.groupBy("digest").agg(
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    clean = _search(docs, [], keep).drop("spans", "items")
    none = lambda name, kind: F.coalesce(name, F.array().cast(f"array<{kind}>")).alias(name)
    return clean.join(stored(joined, "all-hits"), "digest", "left").select(
        "row", "n_words", none("spans", "bigint"), none("items", "string")
    )


def judge_rows(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, keep: Sequence[str] | None = None
) -> DataFrame:
    """(row, n_words, n_hit, items, spans, contaminated) of every row of ``docs``.

    ``row`` holds the row's columns, or those in ``keep``. With a benchmark of one block rows only
    pass by: nothing is joined or shuffled.
    """
    keep = docs.columns if keep is None else keep
    items = _items(benchmark)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    rows = _search(docs, _block(items, 0, 1), keep) if n == 1 else _search_blocks(docs, items, n, keep)
    odd = lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)
    n_hit = F.aggregate(F.transform("spans", odd), F.lit(0).cast("long"), lambda total, x: total + x)
    found = rows.withColumn("n_hit", n_hit)
    dirty: Column = (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    return found.select("row", "n_words", "n_hit", "items", "spans", dirty.alias("contaminated"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans, contaminated) of every row of ``docs``.

    ``items`` are the sorted ids whose windows occur, ``spans`` the word ranges to remove,
    as [start, end, start, end, ...].
    """
    found = judge_rows(docs, benchmark, block_bytes, keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "items", "spans", "contaminated")


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = r"""
with fold as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
bench as (
  select item_id::varchar as item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null and text is not null),
windows as (
  select distinct item, least(len(w), 13) as n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') as gram
  from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from bench where len(w) > 0)),
places as (select r, w, unnest(range(1, len(w) + 1)) as i from fold),
grams as (
  select r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as gram
  from places, (select distinct n from windows) where i + n - 1 <= len(w)),
occ as (select r, i, g.n, item from grams g join windows v on g.n = v.n and g.gram = v.gram),
hit as (
  select r, count(distinct i + d) as n from (select distinct r, i, n from occ), range(0, 13) as v(d)
  where d < n group by r),
listed as (
  select r, count(*) as n, string_agg(item, ',' order by item) as items
  from (select distinct r, item from occ) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit,
  coalesce(listed.n, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from fold left join hit using (r) left join listed using (r)
"""
