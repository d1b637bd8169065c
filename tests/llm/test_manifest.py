import hashlib
import zlib

import pytest
from llm.conftest_llm import ODD_TEXTS
from pyspark.sql import functions as F

from fiscalake.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_above(nodes):
    """All levels of a tree, from its leaves to its only root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[k : k + 3]) for k in range(0, len(last), 3)])
    return levels


def climb(levels, at, shown):
    """Siblings of a leaf from the lowest level, and the node that ``shown`` leads to."""
    beside = []
    for level in levels[:-1]:
        run = level[at // 3 * 3 : at // 3 * 3 + 3]
        own = at % 3
        beside += run[:own] + run[own + 1 :]
        shown = h(*run[:own], shown, *run[own + 1 :])
        at //= 3
    return beside, shown


def brute(rows, shown_text):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of rows as in SCHEMA."""
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_above([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top = levels_above([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, _, digest, r) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            beside, folded = climb(trees[s], at, leaf(r[0], shown_text(r), *r[2:]))
            more, folded = climb(top, k, folded)
            root = top[-1][0]
            out.append((r[0], digest, trees[s][-1][0], root, h(*beside, *more), folded, folded == root))
    return sorted(out, key=repr)


def found(df):
    rows = df.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("witness")), 256), "folded_root", "verified"
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 81, 243])
def test_a_stream_of_appends_is_the_tree(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    frontier = manifest.Frontier()
    for x in leaves:
        frontier.append(x)
    root = frontier.close(manifest.levels_of(n))
    levels = levels_above([x.hex() for x in leaves])
    assert root.hex() == levels[-1][0]
    for k, x in enumerate(leaves):
        witness, steps = bytes(frontier.witnesses[k]), bytes(frontier.steps[k])
        assert witness.hex() == "".join(climb(levels, k, x.hex())[0])
        assert manifest.fold(x, steps, witness) == root


def test_manifest_equals_brute_force(frame):
    rows = [(k, f"text {k}\nx", "en", "hot", k) for k in range(1000)]  # several blocks
    rows += [(k, t, "de", "odd", None) for k, t in enumerate(ODD_TEXTS) if t != "\x00"]
    rows += [(k, "a\nb", None, None, 1) for k in range(3)] + [(None, None, None, None, None)] * 2
    rows += [(7, "same", "en", "twice", 4)] * 300 + [(7, "other", "en", "twice", 5), (1, "x", "en", "", 1), (2, "y", "en", "é", 1)]
    docs = frame(rows, SCHEMA)
    assert found(manifest.manifest(docs)) == brute(rows, lambda r: r[1])
    assert all(r[-1] for r in found(manifest.manifest(docs)))
    changed = lambda r: r[1].replace("\n", "") if r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 else r[1]
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1
    shown = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = found(manifest.manifest(docs, shown))
    assert got == brute(rows, changed) and 0 < sum(r[-1] for r in got) < len(got)


def test_few_rows(frame):
    assert manifest.manifest(frame([], SCHEMA)).count() == 0
    one = [(5, "a", "en", "s", 1)]
    ((_, digest, subroot, root, proof, _, verified),) = found(manifest.manifest(frame(one, SCHEMA)))
    assert digest == subroot == root == leaf(*one[0]) and proof == h() and verified
