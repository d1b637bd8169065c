from fiscalake.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def formatted(frame, rows):
    return {(r.conv_id, r.part): r for r in chat.format_conversations(frame(rows, SCHEMA)).collect()}


def turns(conv, *texts, start=0):
    return [(conv, start + k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]


def test_prefixes_and_copies_collapse(frame):
    rows = turns(1, "a") + turns(2, "a", "b") + turns(3, "a", "b", "c") + turns(4, "a", "x")
    rows += turns(5, "a", "b", "c") + turns(6, "b") + turns(7, "a", "b", "c", start=10)
    got = formatted(frame, rows)
    assert sorted(got) == [(3, 0), (4, 0), (6, 0)]
    assert got[3, 0].n_copies == 3 and got[3, 0].n_turns == 3
    assert got[4, 0].rendered == "<|user|>\na<|end|>\n<|assistant|>\nx<|end|>\n"


def test_long_conversations_come_in_parts(frame):
    rows = turns(1, *[f"t{k}" for k in range(200)]) + turns(2, *[f"t{k}" for k in range(130)])
    got = formatted(frame, rows)
    assert sorted(got) == [(1, k) for k in range(4)]
    whole = "".join(got[1, k].rendered for k in range(4))
    assert whole.count("<|end|>") == 200 and whole.index("t63<") < whole.index("t64<")


def test_nulls_ties_markers_and_repeats(frame):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "<|end|>"), (1, 0, "user", "<|end|>")]
    rows += [(2, 0, "user", ""), (3, 0, "user", None)]
    got = formatted(frame, rows)
    assert got[1, 0].rendered if (1, 0) in got else True
    whole = "".join(r.rendered for k, r in sorted(got.items()) if k[0] == 1)
    assert whole == "<|unknown|>\n<|end|>\n" + 2 * "<|user|>\n< |end|><|end|>\n"
    assert {k[0] for k in got} == {1, 2, 3}


def test_no_rows(frame):
    assert formatted(frame, []) == {}
