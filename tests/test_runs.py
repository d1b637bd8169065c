import hashlib
import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import SF_DIR, revenue
from pyspark.errors import PySparkException

from fiscalake.operators import periods, runs
from fiscalake.queries import registry
from fiscalake.sources import landing, manifests, snapshots
from fiscalake.sources.schemas import EXPENSES, REVENUES

RECORD_COLUMNS = (
    "municipio string, exercicio int, mes_particao int, orgao string, mes string, "
    "ds_fonte_recurso string, ds_cd_aplicacao_fixo string, ds_alinea string, "
    "ds_subalinea string, vl_arrecadacao string"
)
PLAN_COLUMNS = "municipio string, exercicio int, mes_particao int"


def run(**changes):
    row = {
        "run_id": "r1",
        "status": "success",
        "dataset": "receitas",
        "municipality": "salto",
        "year": 2021,
        "month": 2,
        "source_url": "http://x",
        "record_count": 3,
        "content_length_bytes": 100,
        "sha256": "abc",
        "started_at_utc": "2021-02-01T10:00:00+00:00",
        "completed_at_utc": "2021-02-01T10:00:02.500000Z",
        "output_path": "p",
        "error_type": None,
        "error_message": None,
    }
    return {**row, **changes}


def full_run(**changes):
    row = {
        "run_id": "p1",
        "execution_source": "scheduled",
        "status": "success",
        "dry_run": False,
        "started_at_utc": "2021-02-01T10:00:00+00:00",
        "completed_at_utc": "2021-02-01T10:01:30+00:00",
        "duration_seconds": 90.0,
        "failed_stage": None,
        "error_message": None,
    }
    return {**row, **changes}


@pytest.fixture
def manifest(tmp_path):
    def write(*lines):
        path = tmp_path / "manifest.jsonl"
        texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
        path.write_text("\n".join(texts) + "\n", encoding="utf-8")
        return str(path)

    return write


def without(record, *keys):
    return {k: v for k, v in record.items() if k not in keys}


def test_ingestion_runs_are_typed(spark, manifest):
    path = manifest(
        run(),
        run(run_id="r2", status="empty", record_count=0),
        run(
            run_id="r3", status="failed", record_count=None, content_length_bytes=None,
            completed_at_utc=None, extracted_at_utc="2021-02-01T10:00:01Z", source_url=None,
        ),
        run(run_id="r4", started_at_utc=None),
    )
    rows = manifests.read_ingestion_runs(spark, path).orderBy("manifest_line_number").collect()
    assert [r.manifest_line_number for r in rows] == [1, 2, 3, 4]
    assert rows[0].duration_seconds == 2.5
    assert (rows[2].record_count, rows[2].content_length_bytes) == (0, None)
    assert rows[2].duration_seconds == 1.0
    assert rows[3].duration_seconds is None
    types = dict(manifests.read_ingestion_runs(spark, path).dtypes)
    assert (types["year"], types["record_count"], types["started_at_utc"]) == (
        "int", "bigint", "timestamp",
    )


@pytest.mark.parametrize(
    "line, reason",
    [
        ("{broken", "invalid JSON"),
        ("   ", "blank line"),
        ("[1]", "not a JSON object"),
        (without(run(), "year", "dataset"), "missing keys: dataset, year"),
        (run(status="unknown"), "unknown status: unknown"),
        (run(status=None), "unknown status: null"),
        (run(year=None), "year and month must be integers"),
        (run(started_at_utc="yesterday"), "invalid timestamp"),
        (run(record_count="many"), "counters must be integers"),
    ],
)
def test_bad_ingestion_lines_are_rejected_with_their_number(spark, manifest, line, reason):
    path = manifest(run(), line, run())
    parsed = manifests.parse_ingestion_runs(manifests.numbered_lines(spark, path))
    assert [tuple(r)[:2] for r in parsed.rejects.collect()] == [(2, reason)]
    assert parsed.runs.count() == 2
    with pytest.raises(manifests.ManifestError, match="manifest.jsonl: line 2"):
        manifests.read_ingestion_runs(spark, path)


def test_required_keys_may_hold_null(spark, manifest):
    assert manifests.read_ingestion_runs(spark, manifest(run(municipality=None))).count() == 1


def test_missing_manifests(spark, tmp_path):
    absent = str(tmp_path / "absent.jsonl")
    with pytest.raises(FileNotFoundError):
        manifests.read_ingestion_runs(spark, absent)
    empty = manifests.read_full_runs(spark, absent)
    assert empty.count() == 0
    assert empty.schema == manifests.FULL_RUN_SCHEMA


@pytest.mark.parametrize(
    "line, reason",
    [
        ("", "blank line"),
        (without(full_run(), "duration_seconds"), "missing keys: duration_seconds"),
        (full_run(status="empty"), "unknown status: empty"),
        (full_run(dry_run="false"), "dry_run must be a boolean"),
        (full_run(completed_at_utc=None), "invalid timestamp"),
        (full_run(duration_seconds="long"), "duration_seconds must be a number"),
    ],
)
def test_bad_full_run_lines(spark, manifest, line, reason):
    parsed = manifests.parse_full_runs(manifests.numbered_lines(spark, manifest(line, full_run())))
    assert [tuple(r)[:2] for r in parsed.rejects.collect()] == [(1, reason)]
    assert [r.manifest_line_number for r in parsed.runs.collect()] == [2]


def test_line_numbers_across_blocks_and_files(spark, tmp_path):
    """Each file is cut into many blocks; numbers still run through it."""
    for name, n in (("a", 500), ("b", 300)):
        lines = [f"{name}{i} {'x' * (i % 40)}" for i in range(1, n + 1)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = manifests.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 800
    for r in rows:
        name = r.file.rsplit("/", 1)[1][0]
        assert r.line.split(" ")[0] == f"{name}{r.line_number}"


def _records(spark, *keys):
    rows = [{**revenue(), "municipio": m, "exercicio": y, "mes_particao": p} for m, y, p in keys]
    return spark.createDataFrame(rows, RECORD_COLUMNS)


def test_landing_writes_a_manifest_row_per_snapshot(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "manifest")
    records = _records(spark, ("salto", 2021, 2), ("salto", 2021, 2), ("itu", 2021, 1))
    planned = spark.createDataFrame(
        [("salto", 2021, 2), ("salto", 2021, 3), ("itu", 2021, 1)], PLAN_COLUMNS
    )
    stamp = landing.land(records, bronze, path, REVENUES, planned, source_url="http://x")
    rows = manifests.read_ingestion_runs(spark, path).collect()
    found = {(r.municipality, r.month): r for r in rows}
    assert {k: (r.status, r.record_count) for k, r in found.items()} == {
        ("salto", 2): ("success", 2),
        ("salto", 3): ("empty", 0),
        ("itu", 1): ("success", 1),
    }
    for r in rows:
        folder = r.output_path.removeprefix("file:")
        assert folder.endswith(f"snapshot={stamp}")
        (part,) = list(Path(folder).glob("part-*"))
        assert r.sha256 == hashlib.sha256(part.read_bytes()).hexdigest()
        assert r.content_length_bytes == part.stat().st_size
        assert r.duration_seconds >= 0


def test_checksums_of_all_orders_equal_the_landed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 5)
    records, base = registry._orders_as_records(spark, SF_DIR), str(tmp_path / "bronze")
    landing.land(records, base, f"{base}/manifest", EXPENSES, planned=records)
    several, landed = 0, 0
    for r in manifests.read_ingestion_runs(spark, f"{base}/manifest").collect():
        folder = Path(base, EXPENSES, f"municipio={r.municipality}", f"exercicio={r.year}", f"mes={r.month:02d}")
        files = [p.read_bytes() for p in folder.glob("snapshot=*/part-*")]
        shas = [hashlib.sha256(raw).hexdigest() for raw in files]
        words = [sum(int(x[8 * k : 8 * k + 8], 16) for x in shas) % 2**32 for k in range(8)]
        assert r.sha256 == "".join(f"{w:08x}" for w in words)
        assert r.content_length_bytes == sum(map(len, files))
        assert r.record_count == sum(raw.count(b"\n") for raw in files)
        several, landed = several + (len(files) > 1), landed + r.record_count
    assert several and landed == records.count()


def test_failed_landing_is_recorded_and_raised(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "manifest")
    records = _records(spark, ("salto", 2021, 2))
    planned = spark.createDataFrame([("salto", 2021, 2)], PLAN_COLUMNS)
    landing.land(records, bronze, path, REVENUES, planned, stamp="20210301T000000Z")
    with pytest.raises(FileExistsError):
        landing.land(records, bronze, path, REVENUES, planned, stamp="20210301T000000Z")
    rows = manifests.read_ingestion_runs(spark, path).orderBy("status").collect()
    assert [(r.status, r.error_type) for r in rows] == [
        ("failed", "FileExistsError"),
        ("success", None),
    ]
    assert snapshots.read_latest(spark, bronze, REVENUES).count() == 1


def test_records_that_cannot_be_read_leave_a_failed_run(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "manifest")
    broken = _records(spark, ("salto", 2021, 2)).selectExpr(
        "* except (municipio)", "cast(raise_error('unreadable') as string) as municipio"
    )
    planned = spark.createDataFrame([("salto", 2021, 2), ("itu", 2021, 1)], PLAN_COLUMNS)
    with pytest.raises(Exception, match="unreadable"):
        landing.land(broken, bronze, path, REVENUES, planned)
    rows = manifests.read_ingestion_runs(spark, path).collect()
    assert sorted((r.municipality, r.month, r.status) for r in rows) == [
        ("itu", 1, "failed"), ("salto", 2, "failed"),
    ]
    assert "unreadable" in rows[0].error_message


def test_times_without_a_zone_are_utc(spark, manifest):
    path = manifest(run(started_at_utc="2021-02-01T10:00:00", completed_at_utc="2021-02-01T10:00:02"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        micros = manifests.read_ingestion_runs(spark, path).selectExpr("unix_micros(started_at_utc)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert micros == 1612173600 * 10**6


START = datetime(2021, 2, 1, 10, tzinfo=timezone.utc)


def _full_run(spark, **changes):
    values = {
        "run_id": "p1",
        "execution_source": "manual",
        "status": "success",
        "started_at": START,
        "completed_at": START + timedelta(seconds=90),
        "dry_run": False,
    }
    return landing.full_run_record(spark, **{**values, **changes})


def test_full_runs_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "runs")
    landing.append_full_runs(_full_run(spark), path)
    failed = _full_run(
        spark, run_id="p2", status="failed", failed_stage="transform", error_message="no",
        completed_at=START + timedelta(seconds=100), dry_run=True,
    )
    landing.append_full_runs(failed, path)
    table = manifests.read_full_runs(spark, path)
    rows = table.orderBy("run_id").collect()
    assert [(r.run_id, r.status, r.duration_seconds) for r in rows] == [
        ("p1", "success", 90.0),
        ("p2", "failed", 100.0),
    ]
    last = runs.last_full_run(table).collect()
    assert [(r.run_id, r.dry_run, r.failed_stage) for r in last] == [("p2", True, "transform")]
    assert runs.last_full_run(table.limit(0)).count() == 0


def test_invalid_full_runs_are_refused(spark, tmp_path):
    for changes in ({"status": "empty"}, {"failed_stage": "transform"}):
        with pytest.raises(PySparkException):
            landing.append_full_runs(_full_run(spark, **changes), str(tmp_path / "runs"))


def test_indicators(spark, manifest):
    path = manifest(
        run(),
        run(status="failed", record_count=None, completed_at_utc="2021-02-03T10:00:00Z",
            started_at_utc="2021-02-03T09:59:59.5Z"),
        run(status="empty", record_count=0, started_at_utc=None),
    )
    table = manifests.read_ingestion_runs(spark, path)
    row = runs.extraction_indicators(table).first()
    assert (row.calls, row.calls_success, row.calls_empty, row.calls_failed) == (3, 1, 1, 1)
    assert (row.records_processed, row.mean_duration_seconds) == (3, 1.5)
    assert row.last_extraction_at.day == 3
    summary = runs.batch_summary(table).first()
    assert tuple(summary) == (3, 1, 1, 1)


def _months(df):
    return [(r.exercicio, r.mes) for r in df.orderBy("exercicio", "mes").collect()]


def test_period_plans(spark):
    got = _months(periods.period_plan(spark, 2024, 2025, 3))
    assert len(got) == 15 and got[0] == (2024, 1) and got[11:] == [
        (2024, 12), (2025, 1), (2025, 2), (2025, 3),
    ]
    assert len(_months(periods.period_plan(spark, 2024, 2024))) == 12
    assert len(_months(periods.recurring_plan(spark, date(2025, 3, 9)))) == 15
    assert _months(periods.recurring_plan(spark, date(2025, 3, 9), previous_year=False)) == [
        (2025, 1), (2025, 2), (2025, 3),
    ]
    assert periods.load_plan(periods.period_plan(spark, 2024, 2024)).count() == 24


@pytest.mark.parametrize("args", [(2025, 2024), (2024, 2025, 0), (2024, 2025, 13)])
def test_impossible_periods(spark, args):
    with pytest.raises(ValueError):
        periods.period_plan(spark, *args)


def test_missing_periods(spark, manifest):
    path = manifest(run(month=1), run(month=2, status="failed"), run(month=3, status="empty"))
    plan = periods.load_plan(
        periods.with_months(
            spark.createDataFrame([("salto",)], "municipio string"), 2021, 2021, 3
        ),
        ["receitas"],
    )
    missing = periods.missing_periods(plan, manifests.read_ingestion_runs(spark, path))
    assert _months(missing) == [(2021, 2)]
