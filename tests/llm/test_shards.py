import zlib
from collections import defaultdict

import pytest
from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import shards


def placed(frame, rows, **more):
    return shards.shard_by_bytes(frame(rows, "doc_id bigint, text string"), **more).collect()


@pytest.mark.parametrize("hot", [0, 400])
def test_shares_are_equal_and_slots_gapless(frame, prose, hot):
    rows = [(k, prose(k, k % 90)) for k in range(800)] + [(1000 + k, "same") for k in range(hot)]
    rows += [(5000 + k, t) for k, t in enumerate(ODD_TEXTS[:10])] + [(None, "x"), (3, prose(3, 3))]
    got = placed(frame, rows, shards=7)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (k is None, k or 0, len((t or "").encode()) + 8) for k, t in rows
    )
    assert {(r.size, r.text_crc32) for r in got} == {
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows
    }
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(7))
    mean, largest = sum(r.size for r in got) / 7, max(r.size for r in got)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r.size for r in rs) - mean) <= largest


def test_one_huge_record_and_no_rows(frame):
    got = placed(frame, [(1, "x" * 100_000), (2, "a"), (3, "b")], shards=4)
    assert len(got) == 3 and {r.shard for r in got} <= set(range(4))
    assert placed(frame, []) == []
