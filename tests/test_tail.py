import json
import os

import pytest
from test_runs import run

from fiscalake.sources.manifests import ManifestError, parse_ingestion_runs
from fiscalake.sources.tail import read_tail


def line(k):
    return json.dumps(run(run_id=f"r{k}"))


def write(path, lines, mode="w"):
    with open(path, mode, encoding="utf-8") as file:
        file.writelines(x + "\n" for x in lines)


def test_reading_goes_on_where_it_stopped(spark, tmp_path):
    folder, state = tmp_path / "manifest", str(tmp_path / "state")
    folder.mkdir()
    read = lambda: read_tail(spark, str(folder), state, parse_ingestion_runs)
    places = lambda tail: sorted((r.run_id, r.manifest_line_number, r.manifest_file.rsplit("/", 1)[1]) for r in tail.parsed.runs.collect())

    write(folder / "a.jsonl", [line(1), "{", line(2)])
    write(folder / "b.jsonl", [])
    first = read()
    assert places(first) == [("r1", 1, "a.jsonl"), ("r2", 3, "a.jsonl")]
    assert [r.manifest_line_number for r in first.parsed.rejects.collect()] == [2]
    assert places(read()) == places(first)  # not committed: read again
    first.commit()
    assert places(read()) == [] and read().lines.isEmpty()

    write(folder / "a.jsonl", [line(3)], "a")
    write(folder / "c.jsonl", [line(4), line(5)])
    second = read()
    assert places(second) == [("r3", 4, "a.jsonl"), ("r4", 1, "c.jsonl"), ("r5", 2, "c.jsonl")]
    assert second.lines.count() == 3
    second.commit()
    assert read().lines.isEmpty()

    write(folder / "b.jsonl", [line(6)], "a")
    third = read()
    assert places(third) == [("r6", 1, "b.jsonl")]
    third.commit()


@pytest.mark.parametrize("lines", [[1], [1, 3], [3, 2, 9], [2, 1, 3]])
def test_a_rewritten_file_is_an_error(spark, tmp_path, lines):
    folder, state = tmp_path / "manifest", str(tmp_path / "state")
    folder.mkdir()
    path = folder / "a.jsonl"
    write(path, [line(1), line(2)])
    read_tail(spark, str(folder), state, parse_ingestion_runs).commit()
    write(path, [line(k) for k in lines])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    with pytest.raises(ManifestError, match="a.jsonl"):
        read_tail(spark, str(folder), state, parse_ingestion_runs)
