import random
import re

import numpy as np
import pytest
from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        n = min(13, len(v))
        for s in range(len(v) - n + 1 if v else 0):
            for k in range(len(w) - n + 1):
                if w[k : k + n] == v[s : s + n]:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [10_000_000, 300, 700])
def test_equals_brute_force(frame, prose, block_bytes):
    items = [(k, prose(k, 20 + k)) for k in range(8)] + [(8, "Ab c"), (9, None), (10, "!!"), (0, prose(99, 15))]
    texts = ODD_TEXTS + [prose(100 + k, 80) for k in range(6)]
    texts += [f"{prose(50, 30)} {items[k][1].upper()}. {prose(51, 9)}, AB, c" for k in range(8)]
    texts += [" ".join(words(items[3][1])[:13]), " ".join(words(items[3][1])[:12]), "é" + items[2][1], items[1][1] * 3]
    docs = frame([*enumerate(texts), (2, " ")], "doc_id bigint, text string")
    bench = frame([*items, (None, "x y")], "item_id bigint, text string")
    rows = dc.find_contamination(docs, bench, block_bytes).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = brute(texts[r.doc_id] if len(texts[r.doc_id] or "") < 20_000 else None, items)
        if len(texts[r.doc_id] or "") < 20_000:
            assert (r.n_words, r.n_hit, r["items"], r.contaminated) == want, r.doc_id
        assert r.n_hit == sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2]))


def test_no_items_and_no_rows(frame, prose):
    docs = frame([(1, prose(1, 50))], "doc_id bigint, text string")
    none = frame([], "item_id bigint, text string")
    (row,) = dc.find_contamination(docs, none).collect()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (50, 0, [], False)
    assert dc.find_contamination(docs.limit(0), none).count() == 0


def test_index_finds_and_locates():
    draw = random.Random(5)
    text = np.array([draw.randrange(2, 5) for _ in range(3000)] + [0])
    index = dc.FmIndex(text)
    rows = np.array([[draw.randrange(2, 5) for _ in range(6)] for _ in range(50)])
    low, high = index.search(rows, np.full(50, 6))
    for row, a, b in zip(rows, low, high):
        want = [k for k in range(len(text) - 6) if (text[k : k + 6] == row).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("block_bytes", [10_000_000, 40])
def test_rows_keep_their_columns(frame, prose, block_bytes):
    docs = frame([(1, f"{prose(1, 9)} a b c d e f g h i j k l m"), (2, prose(2, 50))], "doc_id bigint, text string").selectExpr(
        "*", "array(doc_id) as `n_words`", "named_struct('x', text) as `a.b`"
    )
    bench = frame([(7, "a b c d e f g h i j k l m"), (8, "v w x y z and others"), (9, None)], "item_id bigint, text string")
    judged = dc.judge_rows(docs, bench, block_bytes)
    got = {r.row.doc_id: r for r in judged.collect()}
    assert {d: r.contaminated for d, r in got.items()} == {1: True, 2: False} and got[1]["items"] == ["7"]
    assert all(r.row.n_words == [d] and r.row["a.b"].x == r.row.text for d, r in got.items())
