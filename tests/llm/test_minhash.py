import random
import re
from collections import Counter

from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import minhash
from fiscalake.llm.components import connected_components


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute(docs, n):
    sets = {}
    for d, t in docs:
        sets.setdefault(d, []).append(shingles(t, n))
    name = {d: d for d in sets}

    def root(d):
        while name[d] != d:
            d = name[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {d: root(d) for d in ids}


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"e{draw.randrange(10**6)}" if draw.random() < share else w for w in text.split(" "))


def test_components_equal_brute_force(frame, prose):
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS)]
    for g in range(4):
        base = prose(g, 150)
        docs += [(100 * (g + 1) + k, edited(base, 0.01 * k, 7 * g + k)) for k in range(12)]
        docs += [(100 * (g + 1) + 50 + k, base.upper() if k % 2 else base) for k in range(3)]
    docs += [(900, "one"), (901, "ONE"), (902, "one two"), (903, "two one"), (904, " one\ttwo ")]
    for n in (2, 5):
        got = minhash.near_duplicates(frame(docs, "doc_id bigint, text string"), n).collect()
        want = brute(docs, n)
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
        assert {r.doc_id: r.n_shingles for r in got} == {d: len(shingles(t, n)) for d, t in docs}


def test_links_that_no_leader_sees(frame, prose):
    """Copies of a text that is missing: many pairs below the limit, one component."""
    base = prose(77, 300)
    docs = [(k, edited(base, 0.04, k)) for k in range(60)]
    got = minhash.near_duplicates(frame(docs, "doc_id bigint, text string"), 2).collect()
    want = brute(docs, 2)
    assert {r.doc_id: r.component_id for r in got} == want
    assert Counter(want.values()).most_common(1)[0][1] > 5


def test_nulls_repeats_and_no_rows(frame, prose):
    text = prose(1, 50)
    rows = [(None, text), (None, text), (5, text), (5, text), (9, text), (7, None), (8, "")]
    got = minhash.near_duplicates(frame(rows, "doc_id bigint, text string"), 5).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (0, 0, True), (5, 5, True), (5, 5, True), (7, 7, True), (8, 8, True), (9, 5, False),
    ]
    assert minhash.near_duplicates(frame([], "doc_id bigint, text string"), 5).count() == 0


def test_star_steps_name_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 100), (7, 7), (300, 200), (250, 300)]
    found = connected_components(spark.createDataFrame(chain, "x bigint, y bigint"))
    got = {r.id: r.component for r in found.collect()}
    assert got == {**{k: 0 for k in range(41)}, 99: 99, 100: 99, 200: 200, 250: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0
