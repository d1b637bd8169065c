"""Token-id files with Re-Pair grammars.

Texts are dealt to shards by ranges of ``doc_id``, encoded with a tokenizer file, and
every shard is written as a sequence of blocks in ascending order. A block's ids are
compressed by a grammar: in each round the pairs of neighbours are counted and all that pay
for a rule are replaced by new symbols, the frequent ones first where they overlap, so that
later rounds build pairs of pairs. It ends when no pair pays any more. The file keeps the
rules, how many ids each new symbol stands for, and where each document begins, so that one
document is decoded without the others. No pair begins with the end id or a symbol that ends
in it, hence no symbol spans two documents. A shard has one grammar for each block and not one
for all: a task holds the ids of a block alone, and one document is read with its block.

Files are Parquet in the folder that the caller names: Spark's writer puts them into any
store and commits a task's output once, also when executors are lost.

Cases: a null or empty text is the end id alone; repeated rows are written each, equal ids
ordered by a hash of their text; a null id comes first; a block ends after ``BLOCK_IDS``
ids but never within a document, so a very long text is a block of its own; an empty
table gives no blocks and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalake.llm.common import UPPER, lean, table, text_slices
from fiscalake.session import scratch_path

END_ID = 2
BLOCK_IDS = 1 << 20
#: Least times that a pair is replaced.
LEAST_COUNT = 4
NEVER = np.iinfo(np.int32).max
#: Words and bytes of words a worker remembers, and bytes of texts it encodes together.
MEMORY, MEMORY_BYTES, SLICE_BYTES = 1_500_000, 30_000_000, 2_000_000
#: Bytes of the longest word that is remembered.
LONG = 256

_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_LOWER = _SPACES.translate(bytes.maketrans(UPPER.encode(), UPPER.lower().encode()))
#: ASCII signs but apostrophes, which may begin a piece of letters, and ``<``, which may begin the name
#: of a special token.
_SIGNS = b"!#$%&()*+,-./:;=>?@[]^_`{|}~\"\\"
_SIGN = re.escape(_SIGNS.decode())
#: Letters of ASCII and Latin-1 and then signs, or one of both.
_PLAIN = re.compile(rb"(?:(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+[%b]*|[%b]+)" % (_SIGN.encode(), _SIGN.encode()))
_BEFORE_SIGN = re.compile(rf"(?<=[^\x20{_SIGN}])(?=[{_SIGN}])")


class HashTable:
    """Numbers of non-zero 64-bit keys: open addressing in two arrays, looked up all at once."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not held."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, slot = np.arange(len(keys)), (keys >> self.shift).astype(np.int64)
        while len(left):
            held = self.keys[slot]
            hit = held == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (held != 0)
            left, slot = left[on], (slot[on] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not held yet."""
        left, slot = np.arange(len(keys)), (keys >> self.shift).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[left[free]]
            placed = self.keys[slot] == keys[left]  # of several for one slot, one stays
            self.values[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask


class Growing:
    """An array with room behind the ``n`` rows that it holds."""

    def __init__(self, dtype: str, *width: int):
        self.rows, self.n = np.zeros((1024, *width), dtype=dtype), 0

    def put(self, more: np.ndarray) -> None:
        """Behind the rows held; they are overwritten by the next unless ``n`` is raised."""
        upto = self.n + len(more)
        if upto > len(self.rows):
            rows = np.zeros((max(upto, len(self.rows) * 3 // 2), *self.rows.shape[1:]), dtype=self.rows.dtype)
            rows[: self.n] = self.rows[: self.n]
            self.rows = rows
        self.rows[self.n : upto] = more

    def trim(self) -> None:
        """Let go of room that one very long text took."""
        if len(self.rows) > 2 * self.n + (1 << 20):
            self.rows = self.rows[: self.n + 1024].copy()


#: Of 8 bytes the first so many.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _eights(joined: bytes, starts: np.ndarray, lengths: np.ndarray) -> list[tuple[slice | np.ndarray, np.ndarray]]:
    """For each k the words of more than 8 k bytes, and their next 8 bytes or what is left, as a number."""
    whole = np.frombuffer(joined + bytes(16 - len(joined) % 8), dtype="<u8")
    out, some = [], slice(None)
    for k in range(0, int(lengths.max()), 8):
        if k:
            left = lengths[some]
            some = np.flatnonzero(left > k) if k == 8 else some[left > k]
        begin = starts[some] + k
        shift = ((begin & 7) << 3).astype(np.uint64)
        begin >>= 3
        value = whole[begin] >> shift
        value |= (whole[begin + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        value &= _FIRST_BYTES[np.minimum(lengths[some] - k, 8)]
        out.append((some, value))
    return out


class WordCache:
    """Ids of whole texts from the library's ids of their words.

    The tokenizer's rules never look across white space, and it puts letters into lower
    case, so a text's ids are those of its lower-case words. Words are looked up by 64-bit
    hashes, 8 bytes at a time; what is kept for one takes few bytes, so the words met first,
    which are the common ones, are kept by the million. Their bytes are kept too and compared
    whenever a hash is met; a word whose hash belongs to another is encoded each time. New words
    are encoded many at a time. Plain ones, letters of ASCII or Latin-1 and then perhaps other
    signs, need no normaliser; the token that ends a piece is marked in the vocabulary. All
    others go through the whole tokenizer, one by one.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        }
        self.plain = Tokenizer.from_str(json.dumps(spec))
        suffix = spec["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True
        # each word's number in the table; by number: its first id, its ids, its first 8 bytes, its bytes
        self.table = HashTable(MEMORY.bit_length() + 1)
        self.words = Growing("<i4", 4)
        self.ids = Growing("<u4")
        self.spelled = Growing("<u8")

    def _whole(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [word.decode("utf-8") for word in words]
        found = [f.ids for f in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(found)), dtype="<u4"), np.array([len(f) for f in found])

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # in lower case as the tokenizer would have it, letters and signs apart
        text = _BEFORE_SIGN.sub(" ", b" ".join(words).decode("utf-8").lower())
        (found,) = self.plain.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        pieces = np.cumsum([1 + (word[-1] in _SIGNS and word[0] not in _SIGNS) for word in words])
        if len(ends) != pieces[-1]:
            return self._whole(words)
        return ids, np.diff(ends[pieces - 1], prepend=0)

    def _new(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and sizes of new words, and their places in ``words``, in another order."""
        is_plain = np.array([word.isalpha() or bool(_PLAIN.fullmatch(word)) for word in words], dtype=bool)
        ids, sizes, order = [], [], []
        for flag, encode in ((True, self._plain), (False, self._whole)):
            chosen = np.flatnonzero(is_plain == flag)
            for k in range(0, len(chosen), 1000):
                found, n = encode([words[i] for i in chosen[k : k + 1000].tolist()])
                ids.append(found)
                sizes.append(n)
            order.append(chosen)
        return np.concatenate(ids), np.concatenate(sizes), np.concatenate(order)

    def _hashes(self, eights: list, lengths: np.ndarray) -> np.ndarray:
        """A hash of each word, from its length and its bytes."""
        out = lengths.astype(np.uint64)
        for some, value in eights:
            mixed = (out[some] ^ value) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            out[some] = mixed
        return np.maximum(out * np.uint64(0xD6E8FEB86659FD93), np.uint64(1))

    def _held(self, number: np.ndarray, eights: list, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words by number, whether each has the same bytes as the word at hand)."""
        rows = self.words.rows.take(np.maximum(number, 0), axis=0)
        same = (number >= 0) & (rows[:, 3] == lengths)
        for k, (some, value) in enumerate(eights):
            same[some] &= self.spelled.rows.take(rows[some, 2] + k, mode="clip") == value
        return rows, same

    def _remember(self, own: np.ndarray, rows: np.ndarray, hashes: np.ndarray, eights: list, lengths: np.ndarray):
        """Keep the words ``own``, whose hashes are distinct and not held, if there is room."""
        sizes = (lengths[own] + 7) >> 3
        upto = np.cumsum(sizes)
        n = self.words.n + len(own)
        if not len(own) or n > MEMORY or 8 * (self.spelled.n + int(upto[-1])) > MEMORY_BYTES:
            return
        spelled = np.empty(int(upto[-1]), dtype="<u8")
        place = np.full(len(lengths), -1, dtype=np.int64)
        place[own] = upto - sizes
        for k, (some, value) in enumerate(eights):
            chosen = np.flatnonzero(place[some] >= 0)
            spelled[place[some][chosen] + k] = value[chosen]
        ids = _gathered(self.ids.rows, rows[own, 0].astype(np.int64), rows[own, 1])
        begins = self.ids.n + np.cumsum(rows[own, 1]) - rows[own, 1]
        self.words.put(np.stack([begins, rows[own, 1], self.spelled.n + upto - sizes, lengths[own]], axis=1))
        self.table.add(hashes[own], np.arange(self.words.n, n))
        self.ids.put(ids)
        self.spelled.put(spelled)
        self.words.n, self.ids.n, self.spelled.n = n, self.ids.n + len(ids), self.spelled.n + len(spelled)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = []
        for text in texts:
            part = (text or "").encode("utf-8")
            # the names of special tokens are told apart by case
            parts.append(part.translate(_SPACES if b"<|" in part else _LOWER))
        joined = b" ".join(parts)
        raw = np.frombuffer(joined, dtype=np.uint8)
        edge = np.concatenate([[-1], np.flatnonzero(raw == 32), [len(raw)]])
        lengths = np.diff(edge) - 1
        chosen = np.flatnonzero(lengths)
        starts, lengths = edge[chosen] + 1, lengths[chosen]
        if not len(starts):
            return [np.empty(0, dtype="<u4") for _ in texts]
        eights = _eights(joined, starts, np.minimum(lengths, LONG))
        hashes = self._hashes(eights, lengths)
        number = self.table.get(hashes)
        rows, same = self._held(number, eights, lengths)
        missing, fresh = np.flatnonzero(~same), np.empty(0, dtype=np.int64)
        if len(missing):
            new: dict[bytes, int] = {}
            begins = starts[missing]
            spans = zip(begins.tolist(), (begins + lengths[missing]).tolist())
            which = np.array([new.setdefault(joined[a:b], len(new)) for a, b in spans])
            found, n, order = self._new(list(new))
            made = np.empty((len(new), 2), dtype=np.int64)
            made[order, 0], made[order, 1] = self.ids.n + np.cumsum(n) - n, n
            rows[missing, :2] = made[which]
            self.ids.put(found)
            first = missing[np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))]
            first = first[(number[first] < 0) & (lengths[first] <= LONG)]
            fresh = first[np.unique(hashes[first], return_index=True)[1]]
        n = rows[:, 1].astype(np.int64)
        upto = np.cumsum(n)
        out = _gathered(self.ids.rows, rows[:, 0].astype(np.int64), n)
        self._remember(fresh, rows, hashes, eights, lengths)
        self.ids.trim()
        before = np.cumsum([0] + [len(p) + 1 for p in parts])
        cuts = np.concatenate([[0], upto])[np.searchsorted(starts, before)].tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _shared_words(tokenizer_json: str) -> WordCache:
    """One cache for each Python process: Spark's workers run many tasks."""
    return WordCache(tokenizer_json)


def _apart(rank: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Places whose pair is replaced: better ones first, and never two that share a symbol.

    ``rank`` has one number for each place, less is better, ``NEVER`` is none; ``joined`` tells
    whether the next place is that of the next pair. A place is taken if no neighbour is better.
    Of a run of equal pairs, which only one repeated symbol makes, every second place is taken.
    """
    before, after = np.full(len(rank), NEVER, dtype=rank.dtype), np.full(len(rank), NEVER, dtype=rank.dtype)
    np.copyto(before[1:], rank[:-1], where=joined)
    np.copyto(after[:-1], rank[1:], where=joined)
    taken = (rank < before) & (rank <= after)
    again = np.flatnonzero((rank == before) & (rank < NEVER))
    if len(again):
        first = np.concatenate([[True], np.diff(again) != 1])
        offset = np.arange(len(again)) - np.maximum.accumulate(np.where(first, np.arange(len(again)), 0)) + 1
        even = again[offset % 2 == 0]
        taken[even] = rank[even] <= after[even]
    return taken


def _numbered_pairs(pair: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, pairs, number of each place's pair, counts) of the pairs that occur LEAST_COUNT times.

    Pairs are numbers of ``bits`` bits. They are sorted with their places in the low bits, if these
    fit: numbers are sorted several times faster than their order is found.
    """
    at_bits = np.uint64(len(pair).bit_length())
    if bits + int(at_bits) <= 64:
        ordered = pair << at_bits
        ordered |= np.arange(len(pair), dtype=np.uint64)
        ordered.sort()
        at = (ordered & np.uint64((1 << int(at_bits)) - 1)).view(np.int64)
        ordered >>= at_bits
    else:
        at = np.argsort(pair, kind="stable")
        ordered = pair[at]
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(at) else at
    n = np.diff(np.append(edge, len(at)))
    often = np.flatnonzero(n >= LEAST_COUNT)
    number = np.full(len(edge), -1, dtype=np.int32)
    number[often] = np.arange(len(often), dtype=np.int32)
    by_place = np.empty(len(at), dtype=np.int32)
    by_place[at] = np.repeat(number, n)
    places = np.flatnonzero(by_place >= 0)
    return places, ordered[edge[often]], by_place[places], n[often]


def _round(symbols: np.ndarray, closing: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(places, numbers, pairs, frequent places): where which pair is replaced now; none if no pair pays.

    A pair pays if it is replaced LEAST_COUNT times: a rule takes the space of three symbols.
    Only the places ``at`` are looked at.
    """
    # what closes a document begins no pair: no symbol spans two
    left = symbols[at]
    opens = np.flatnonzero(~closing[left])
    at = at[opens]
    bits = np.uint64(len(closing).bit_length())
    pair = left[opens].astype(np.uint64)
    pair <<= bits
    pair |= symbols[1:][at]
    often, exact, which, n = _numbered_pairs(pair, 2 * int(bits))
    at = at[often]
    joined = np.diff(at) == 1
    order = np.empty(len(exact), dtype=np.int32)
    order[np.argsort(-n, kind="stable")] = np.arange(len(exact), dtype=np.int32)
    pays = np.ones(len(exact), dtype=bool)
    while pays.any():
        taken = np.flatnonzero(_apart(np.where(pays, order, NEVER)[which], joined))
        numbers = which[taken]
        times = np.bincount(numbers, minlength=len(exact))
        enough = times >= LEAST_COUNT
        if enough.any():
            chosen = np.flatnonzero(enough[numbers])
            places, numbers = at[taken[chosen]], numbers[chosen]
            kept = np.flatnonzero(enough)
            renamed = np.full(len(exact), -1, dtype=np.int64)
            renamed[kept] = np.arange(len(kept))
            pairs = np.stack([exact[kept] >> bits, exact[kept] & np.uint64((1 << int(bits)) - 1)], axis=1)
            return places, renamed[numbers], pairs.astype(np.int64), at
        # the best ones overlap themselves too much: the others get their turn
        pays &= times == 0
    return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty((0, 2), dtype=np.int64), at


def re_pair(ids: np.ndarray, base: int, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, lengths, symbols): symbol ``base + k`` is the pair ``rules[k]`` of ``lengths[k]`` ids.

    Rounds go on until no pair pays for its rule. A pair never gets more frequent once both its
    symbols are there, so places of rare pairs are passed over until a symbol beside them is new.
    """
    symbols, rules = ids.astype(np.uint32), [np.empty((0, 2), dtype=np.int64)]
    width = np.ones(base, dtype=np.int64)
    closing = np.arange(base) == end_id
    at = np.arange(len(symbols) - 1)
    while len(symbols) > 1:
        places, numbers, pairs, frequent = _round(symbols, closing, at)
        if not len(places):
            break
        symbols[places] = len(width) + numbers
        keep = np.ones(len(symbols), dtype=bool)
        keep[places + 1] = False
        at = _looked_at(keep, places, frequent)
        symbols = symbols[keep]
        rules.append(pairs)
        width = np.concatenate([width, width[pairs].sum(axis=1)])
        closing = np.concatenate([closing, closing[pairs[:, 1]]])
    return np.concatenate(rules), width[base:], symbols.astype(np.int64)


def _looked_at(keep: np.ndarray, places: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Places of frequent pairs and before new symbols, among the symbols kept, but the last.

    New symbols are at places of frequent pairs; all places ascend.
    """
    before = places[int(places[0] == 0) :] - 1
    if len(frequent) > len(keep) // 32:
        looked_at = np.zeros(len(keep), dtype=bool)
        looked_at[frequent] = looked_at[before] = True
        return np.flatnonzero(looked_at[keep][:-1])
    looked_at = np.unique(np.concatenate([frequent, before]))
    looked_at = looked_at[keep[looked_at]]
    looked_at -= np.searchsorted(places, looked_at)
    return looked_at[looked_at < len(keep) - len(places) - 1]


def _gathered(table: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``table`` that begin at ``first``, one after the other."""
    ends = np.cumsum(size)
    return table[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for.

    Rules are spelled out by generations: those that name no rule of their own generation.
    """
    size = np.concatenate([np.ones(base, dtype=np.int64), lengths])
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    spelled = np.empty(int(size.sum()), dtype=np.int64)
    spelled[:base] = np.arange(base)
    newest, start = rules.max(axis=1, initial=-1) - base, 0
    while start < len(rules):
        later = newest[start:] >= start
        end = start + int(later.argmax()) if later.any() else len(rules)
        parts = rules[start:end].ravel()
        found = _gathered(spelled, first[parts], size[parts])
        spelled[first[base + start] : first[base + start] + len(found)] = found
        start = end
    return _gathered(spelled, first[symbols], size[symbols])


def _packed(values: np.ndarray) -> bytes:
    """Little-endian, 16 bits each if all fit, else 32; the first byte says which."""
    kind = "<u2" if not len(values) or values.max() < 1 << 16 else "<u4"
    return bytes([int(kind[2])]) + values.astype(kind).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int64)


def _block_schema(key: T.DataType) -> T.StructType:
    # starts: of each document among the symbols; sizes: its ids; first: ids before in the shard
    return T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(key)),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("starts", T.BinaryType()),
            T.StructField("base", T.IntegerType()),
            T.StructField("rules", T.BinaryType()),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("symbols", T.BinaryType()),
        ]
    )


def compressed_block(texts_ids: list[np.ndarray], base: int, end_id: int = END_ID) -> dict:
    """The parts of a block that hold the ids of its documents."""
    ids = np.concatenate(texts_ids)
    sizes = np.array([len(x) for x in texts_ids], dtype=np.int64)
    rules, lengths, symbols = re_pair(ids, base, end_id)
    width = np.concatenate([np.ones(base, dtype=np.int64), lengths])[symbols]
    before = np.concatenate([[0], np.cumsum(width)])
    starts = np.searchsorted(before, np.cumsum(sizes) - sizes)
    return {
        "n_ids": len(ids), "sizes": _packed(sizes), "starts": _packed(starts), "base": base,
        "rules": _packed(rules.ravel()), "lengths": _packed(lengths), "symbols": _packed(symbols),
    }


def decode_one(block: dict, k: int) -> np.ndarray:
    """Ids of the block's ``k``-th document alone."""
    starts, symbols = _unpacked(block["starts"]), _unpacked(block["symbols"])
    end = starts[k + 1] if k + 1 < len(starts) else len(symbols)
    rules = _unpacked(block["rules"]).reshape(-1, 2)
    return expand(symbols[starts[k] : end], rules, _unpacked(block["lengths"]), block["base"])


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> None:
    """Write every row of ``docs`` (doc_id, text) to ``folder``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    spark = docs.sparkSession
    schema = _block_schema(docs.schema["doc_id"].dataType)
    arrow = {"shard": pa.int32(), "block": pa.int32(), "first": pa.int64(), "n_ids": pa.int64(), "base": pa.int32()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _shared_words(tokenizer_json)
        base = words.tokenizer.get_vocab_size()
        end = np.array([end_id], dtype="<u4")
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        keys: list = []

        def flush() -> pa.RecordBatch:
            nonlocal block, first, ids, keys
            row = {"shard": shard, "block": block, "first": first} | compressed_block(ids, base, end_id)
            block, first = block + 1, first + row["n_ids"]
            columns = {k: pa.array([v], arrow.get(k, pa.binary())) for k, v in row.items()}
            columns["doc_ids"] = pa.array([keys], pa.list_(key_type))
            ids, keys = [], []
            return pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in schema})

        held = 0
        for batch in batches:
            key_type = batch.column("doc_id").type
            for a, b in text_slices(batch.column("text"), SLICE_BYTES):
                some = batch.slice(a, b - a)
                names, texts = some.column("doc_id").to_pylist(), some.column("text").to_pylist()
                for key, found in zip(names, words.encode(texts)):
                    ids.append(np.append(found, end))
                    keys.append(key)
                    held += len(found) + 1
                    if held >= BLOCK_IDS:
                        held = 0
                        yield flush()
        if ids:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        # rows of one id, and equal rows, are told apart, so that ranges can cut among them
        docs.select("doc_id", "text", F.xxhash64("text").alias("order"), F.monotonically_increasing_id().alias("seq"))
        .repartitionByRange(parts, "doc_id", "order", "seq")
        .sortWithinPartitions("doc_id", "order", "seq")
        .mapInArrow(lean(write), schema)
        .write.parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``folder``."""
    blocks = spark.read.parquet(folder)
    key = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                sizes = _unpacked(block["sizes"])
                rules = _unpacked(block["rules"]).reshape(-1, 2)
                ids = expand(_unpacked(block["symbols"]), rules, _unpacked(block["lengths"]), block["base"])
                raw = memoryview(ids.astype("<u4")).cast("B")
                ends = np.cumsum(sizes)
                spans = zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist())
                n = len(sizes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([block["shard"]] * n, pa.int32()),
                        "doc_id": pa.array(block["doc_ids"], batch.column("doc_ids").type.value_type),
                        "start": pa.array(block["first"] + ends - sizes, pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    }
                )

    # one row for each shard: as many as the writer had tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    shards = (
        blocks.groupBy("shard")
        .agg(F.sum("n_ids").alias("n"))
        .select("shard", (F.sum("n").over(before) - F.col("n")).alias("before"))
    )
    decoded = blocks.mapInArrow(
        lean(read), f"shard int, doc_id {key}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return decoded.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_re_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder
    )
    return read_token_files(spark, folder)
