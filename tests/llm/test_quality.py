import re
from collections import Counter

from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(frame, prose):
    texts = ODD_TEXTS + [prose(k, n) for k, n in enumerate((2, 3, 60, 300))]
    texts += ["a b c a b c a", "x y x y x y", "l\nl\n\nl\n m", "a b c #$% <|>"]
    docs = frame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality.rule_ledger(docs).collect()}
    for k, text in enumerate(texts):
        r = got[k]
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == brute(text), (k, (text or "")[:30])
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert bool(r.failed & quality.policy_mask("base")) == base


def test_policies_and_ablations_follow_the_bits(frame, prose):
    good = prose(1, 80)
    rows = [(1, good), (2, "short"), (3, "again and again " * 40), (4, good + " #" * 40), (None, good)]
    ledger = quality.rule_ledger(frame(rows, "doc_id bigint, text string"))
    kept = {r.doc_id: (r.kept_base, r.kept_v2) for r in quality.apply_policies(ledger).collect()}
    assert kept == {1: (True, True), 2: (False, False), 3: (False, False), 4: (True, False), None: (True, True)}
    cost = {(r.version, r.rule): (r.n_failed, r.n_only) for r in quality.ablations(ledger).collect()}
    assert cost["v2", "symbols"] == (1, 1)
    assert cost["base", "few_words"] == (1, 1)
    assert cost["v2", "word_length"] == (0, 0)


def test_no_rows(frame):
    empty = quality.rule_ledger(frame([], "doc_id bigint, text string"))
    assert empty.count() == 0 and quality.ablations(empty).count() == 0
