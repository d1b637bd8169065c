import os
import zlib

import numpy as np
import public_tokenizers
from llm.conftest_llm import ODD_TEXTS
from tokenizers import Tokenizer

from fiscalake.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_files_hold_what_the_library_encodes(spark, frame, prose, tmp_path):
    texts = ODD_TEXTS[:10] + [prose(k, 60 * k) for k in range(30)] + ["a <|endoftext|> ÉTÉ don't", "x  y"]
    rows = [(len(texts) - k, t) for k, t in enumerate(texts)]
    docs = frame(rows, "doc_id bigint, text string")
    tf.write_token_files(docs, PATH, str(tmp_path / "files"))
    got = sorted(tf.read_token_files(spark, str(tmp_path / "files")).collect())
    library, start = Tokenizer.from_file(PATH), 0
    assert [r.doc_id for r in got] == sorted(k for k, _ in rows)
    for r, (_, text) in zip(got, sorted(rows)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_nulls_repeats_and_no_rows(spark, frame, tmp_path):
    docs = frame([(None, "x"), (1, "a"), (1, "a"), (1, "b")], "doc_id bigint, text string")
    tf.write_token_files(docs, PATH, str(tmp_path / "a"))
    got = tf.read_token_files(spark, str(tmp_path / "a")).collect()
    assert sorted(r.start for r in got) == [0, 2, 4, 6] and got[0].n_tokens == 2
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 1, 1, 1]
    tf.write_token_files(docs.limit(0), PATH, str(tmp_path / "b"))
    assert tf.read_token_files(spark, str(tmp_path / "b")).count() == 0
    assert os.listdir(tmp_path / "b")


def test_grammar_round_trip_and_random_access():
    draw = np.random.default_rng(3)
    texts = [np.append(draw.integers(3, 40, n), 2) for n in (0, 5, 4000, 9000, 1, 20_000)]
    texts.append(np.array([7] * 999 + [2]))
    block = tf.compressed_block(texts, 100)
    rules = tf._unpacked(block["rules"]).reshape(-1, 2)
    symbols = tf._unpacked(block["symbols"])
    whole = tf.expand(symbols, rules, tf._unpacked(block["lengths"]), 100)
    assert (whole == np.concatenate(texts)).all()
    assert len(rules) and len(symbols) < len(whole)
    for k, text in enumerate(texts):
        assert (tf.decode_one(block, k) == text).all()


def spelled_out(ids, base=60_000):
    rules, lengths, symbols = tf.re_pair(ids, base)
    assert (tf.expand(symbols, rules, lengths, base) == ids).all()
    return rules, lengths, symbols


def test_pairs_are_replaced_until_none_pays():
    run = np.full(200_000, 7)
    rules, lengths, symbols = spelled_out(run)
    assert len(symbols) < 20 and len(rules) < 20 and lengths.max() >= 32_768
    draw = np.random.default_rng(4)
    passage = draw.integers(3, 50_000, 60)
    copies = np.concatenate([np.append(passage, draw.integers(3, 50_000, 2)) for _ in range(3000)])
    rules, lengths, symbols = spelled_out(copies)
    assert 60 in lengths.tolist() and len(symbols) < 3.3 * 3000
    mixed = draw.integers(3, 12, 30_000)
    rules, _, symbols = spelled_out(mixed)
    left = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)[1]
    assert (left >= 2 * tf.LEAST_COUNT).sum() == 0
    assert len(spelled_out(np.array([5]))[2]) == 1 and len(spelled_out(np.array([], dtype=np.int64))[2]) == 0


def test_no_symbol_spans_two_documents():
    texts = [np.array([5, 6, 2])] * 500
    block = tf.compressed_block(texts, 100)
    starts = tf._unpacked(block["starts"])
    assert len(np.unique(starts)) == 500 and len(tf._unpacked(block["symbols"])) == 500
    assert all((tf.decode_one(block, k) == texts[k]).all() for k in (0, 250, 499))


def test_words_that_share_a_hash_get_their_own_ids(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        words = tf.WordCache(file.read())
    library = Tokenizer.from_file(PATH)
    right = lambda t: library.encode(t, add_special_tokens=False).ids
    whole = tf.WordCache._hashes
    monkeypatch.setattr(tf.WordCache, "_hashes", lambda self, *a: whole(self, *a) % np.uint64(5) + np.uint64(1))
    for texts in (["alpha"], ["alpha beta"], ["gamma delta epsilon zeta eta theta"], ["alpha", "iota kappa"], ["omega"]):
        assert [x.tolist() for x in words.encode(texts)] == [right(t) for t in texts]


def test_rounds_pass_over_places_of_rare_pairs(monkeypatch):
    draw = np.random.default_rng(5)
    words = [draw.integers(3, 900, draw.integers(2, 9)) for _ in range(300)]
    ids = np.concatenate([words[k] for k in draw.integers(0, 300, 4000)] + [draw.integers(3, 900, 5000)]).astype("<u4")
    looked_at, one_round = [], tf._round

    def noted(symbols, closing, at):
        looked_at.append((len(at), len(symbols) - 1))
        everywhere = one_round(symbols, closing, np.arange(len(symbols) - 1))
        found = one_round(symbols, closing, at)
        assert all(np.array_equal(a, b) for a, b in zip(found, everywhere))
        return found

    monkeypatch.setattr(tf, "_round", noted)
    rules, lengths, symbols = tf.re_pair(ids, 900)
    assert np.array_equal(tf.expand(symbols, rules, lengths, 900), ids)
    assert len(looked_at) > 3 and looked_at[-1][0] < looked_at[-1][1] / 2


def test_rounds_work_on_the_places_looked_at_alone(monkeypatch):
    draw = np.random.default_rng(6)
    words = [draw.integers(3, 900, draw.integers(2, 9)) for _ in range(300)]
    ids = np.concatenate([words[k] for k in draw.integers(0, 300, 4000)] + [draw.integers(3, 900, 5000)])
    compared, apart = [], tf._apart
    monkeypatch.setattr(tf, "_apart", lambda rank, *a: compared.append(len(rank)) or apart(rank, *a))
    _, _, symbols = tf.re_pair(ids, 900)
    assert len(compared) > 3 and compared[-1] < len(symbols) / 4


def test_pairs_too_wide_to_be_sorted_with_their_places():
    draw = np.random.default_rng(7)
    narrow = np.concatenate([draw.integers(3, 60, 400)] * 9)
    rules, _, symbols = spelled_out(narrow, 1 << 8)
    wide_rules, _, wide_symbols = spelled_out(narrow, 1 << 27)
    moved = (1 << 27) - (1 << 8)
    assert np.array_equal(np.where(rules < 1 << 8, rules, rules + moved), wide_rules)
    assert np.array_equal(np.where(symbols < 1 << 8, symbols, symbols + moved), wide_symbols)


class Noted:
    """A tokenizer that notes the texts it encodes."""

    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode_batch(self, texts, **a):
        self.seen.extend(texts)
        return self.tokenizer.encode_batch(texts, **a)

    def encode_batch_fast(self, texts, **a):
        self.seen.extend(w for text in texts for w in text.split())
        return self.tokenizer.encode_batch_fast(texts, **a)


def noted_cache():
    with open(PATH, encoding="utf-8") as file:
        words = tf.WordCache(file.read())
    seen = []
    words.tokenizer, words.plain = Noted(words.tokenizer, seen), Noted(words.plain, seen)
    return words, seen


def test_each_word_is_encoded_once_and_its_hash_may_be_shared(monkeypatch):
    library = Tokenizer.from_file(PATH)
    long = "x" * 300 + "y"
    texts = ["one two\x00 three one", "two " + long + " Four! eightchr eightchrs", "ÉTÉ two two\x00\x00", "日本 " + long, None]
    right = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    words, seen = noted_cache()
    assert [x.tolist() for x in words.encode(texts)] == right and len(seen) == len(set(seen))
    seen.clear()
    assert [x.tolist() for x in words.encode(texts[::-1])] == right[::-1]
    assert seen == [long]  # longer than what is remembered
    whole = tf.WordCache._hashes
    monkeypatch.setattr(tf.WordCache, "_hashes", lambda self, *a: whole(self, *a) % np.uint64(2) + np.uint64(1))
    words, seen = noted_cache()
    for _ in range(3):
        assert [x.tolist() for x in words.encode(texts)] == right
    assert not set(seen) & set(t for t in texts if t and " " in t)  # words alone, never their texts


def test_full_memory_changes_no_ids(monkeypatch, prose):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(tf, "MEMORY", 50)
    words, _ = noted_cache()
    for k in range(8):
        texts = [prose(10 * k + j, 40) for j in range(4)] + ["x" * 255, "x" * 256, "x" * 257, "a" * 7 + " " + "a" * 9]
        assert [x.tolist() for x in words.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert words.words.n <= 50
    many = " ".join(map(str, range(400_000)))
    assert words.encode([many])[0].tolist() == library.encode(many, add_special_tokens=False).ids
    assert words.ids.rows.nbytes < 100_000 and words.encode(["12 x"])[0].tolist() == library.encode("12 x").ids
