import hashlib
import re
import zlib

import pytest

from fiscalake.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """Rows of the trie of conversations that are rebuilt; ties between turns must be equal rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    sums = {p: [0, 0] for p in members}
    for p in members:
        for d in range(len(p) + 1):
            sums[p[:d]][0] += p not in children
            sums[p[:d]][1] += (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(cs), len(p), parent, len(cs), len(children.get(p, [])), *sums[p], sha))
    return sorted(out, key=repr)


def found(conversations):
    return sorted((tuple(r) for r in trie.prefix_trie(*trie.rebuilt(trie.turns_in_order(conversations))).collect()), key=repr)


def test_trie_equals_brute_force(frame):
    say = lambda c, *texts: [(c, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]
    long = [f"turn number {k}" for k in range(90)]
    rows = []
    for c in range(60):
        rows += say(c, "hello there", "how can I help", f"question {c % 5}", *long[: c % 7])
    rows += say(100, *long) + say(101, *long) + say(102, *long[:70], "other end") + say(103, *long[:40])
    rows += say(205, "", "  ", "a  b\nc") + [(300, None, None, None), (300, 1, "user", "x"), (301, None, "", "")]
    rows += [(None, 0, "user", "nobody")] * 3 + [(400, 2, "user", "same")] * 5 + say(1_000_041, "only one")
    assert found(frame(rows, SCHEMA)) == brute(rows)


def test_hot_nodes_and_long_conversations(frame, monkeypatch):
    monkeypatch.setattr(trie, "HOT", 5)
    monkeypatch.setattr(trie, "STRETCH", 16)
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c, 0, "user", "all say this") for c in range(0, 4000, 20)]
    rows += [(c, 1, "assistant", f"answer {c % 30}") for c in range(0, 4000, 20)]
    rows += [(c, k, "user", f"{k}") for c in (5000, 5020) for k in range(2, 300)]
    assert found(frame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(0, 0, "user", "x")], [(-3, 1, None, "x y")]])
def test_few_rows(frame, rows):
    assert found(frame(rows, SCHEMA)) == brute(rows)
