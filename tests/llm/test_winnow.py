import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import winnow

OURS = winnow.Winnower()
MASK = (1 << 64) - 1


def one_hash(gram):
    """The hash of a gram alone, without rolling."""
    x = sum((ord(c) + 1) * pow(winnow._BASE, k, 1 << 64) for k, c in enumerate(gram)) + len(gram) & MASK
    x ^= x >> 32
    x = x * int(winnow._MIX[0]) & MASK
    x ^= x >> 29
    return (x * int(winnow._MIX[1]) & MASK) >> 32


def brute(text, gram=winnow.GRAM, window=winnow.WINDOW):
    """Chosen (position, hash) of a text, window by window."""
    if not text:
        return []
    width = min(gram, len(text))
    hashes = [one_hash(text[k : k + width]) for k in range(len(text) - width + 1)]
    chosen = set()
    for k in range(max(1, len(hashes) - window + 1)):
        some = hashes[k : k + window]
        chosen.add(max(k + i for i, h in enumerate(some) if h == min(some)))
    return [(p, hashes[p]) for p in sorted(chosen)]


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=150), st.text("ab", max_size=150)))
def test_fingerprint_equals_brute_force(text):
    hashes, positions = OURS.fingerprint(winnow.code_points(text))
    assert list(zip(positions.tolist(), hashes.tolist())) == brute(text)


@settings(max_examples=60, deadline=None)
@given(st.text("abc é", min_size=27, max_size=60), st.text(max_size=80), st.text(max_size=80))
def test_a_shared_run_is_found_where_it_is(run, before, after):
    assert len(run) >= winnow.GRAM + winnow.WINDOW - 1
    a, b = (OURS.fingerprint(winnow.code_points(t)) for t in (run, before + run + after))
    places = {(h, p - len(before)) for h, p in zip(b[0].tolist(), b[1].tolist())}
    assert any((h, p) in places for h, p in zip(a[0].tolist(), a[1].tolist()))


def test_a_long_run_of_one_letter_keeps_few_positions():
    hashes, positions = OURS.fingerprint(winnow.code_points("x" * 1000))
    assert len(set(hashes.tolist())) == 1 and positions[0] == winnow.WINDOW - 1
    assert positions[-1] == 1000 - winnow.GRAM


def expected(rows):
    """Rows (doc_id, ...) as the operator returns them, of [(doc_id, text)]."""
    ids = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0), reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    texts = {}
    for d, t in rows:
        texts.setdefault(d, set()).add(t or "")
    out = []
    for d, t in rows:
        t = t or ""
        assert len(texts[after[d]]) == 1
        (follower,) = texts[after[d]]
        half = len(t) // 2
        changed = t[: len(t) - half] + follower[:half]
        own, other, near = brute(t), brute(changed), brute(follower)
        spelled = lambda found: ",".join(f"{h:08x}:{p}" for p, h in found)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((d, len(t), sha, spelled(own), spelled(other), jaccard(own, other), jaccard(own, near)))
    return sorted(out, key=repr)


def result(docs):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in winnow.compare_with_next(docs).select(*columns).collect()), key=repr)


def test_documents_equal_brute_force(frame, prose):
    odd = [t if t is None or len(t) < 3000 else t[:3000] for t in ODD_TEXTS]
    texts = odd + [prose(k, 60) for k in range(40)] + [prose(3, 60) + " more"]
    rows = [*enumerate(texts), (None, "no id"), (1000, prose(3, 60)), (1000, prose(3, 60)), (-5, "minus")]
    assert result(frame(rows, "doc_id bigint, text string")) == expected(rows)


def test_a_hot_id_is_dealt_over_tasks(frame, spark):
    rows = [(7, "the same text again and again, " * 3)] * 400 + [(k, f"text number {k} of a few others") for k in range(20) if k != 7]
    docs = frame(rows, "doc_id bigint, text string")
    assert result(docs) == expected(rows)
    places = winnow.follow(docs).where("role = 1 and key = 7").select("range", "deal").distinct().count()
    assert places > 1


@pytest.mark.parametrize("rows", [[], [(1, "alone and followed by itself, for ever and ever")], [(None, None)]])
def test_few_rows(frame, rows):
    assert result(frame(rows, "doc_id bigint, text string")) == expected(rows)


def test_long_text_and_likeness(frame):
    text = "".join(chr(97 + k * k % 26) + str(k) for k in range(60_000))
    docs = frame([(1, text), (2, text)], "doc_id bigint, text string")
    for r in result(docs):
        assert r[6] == 1.0 and 0.3 < r[5] <= 1.0
    (a, b) = winnow.fingerprints(docs).collect()
    assert a.hashes == b.hashes and len(a.positions) == len(a.hashes)
    assert np.all(np.diff(a.positions) > 0)
