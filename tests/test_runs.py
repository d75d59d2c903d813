import pytest

from tallyloom.plans import runs as reports
from tallyloom.plans.job import PHASES, WarehouseJob
from tallyloom.plans.runs import RunLog


@pytest.fixture
def log(spark, tmp_path):
    return RunLog(spark, str(tmp_path))


def test_start(log):
    assert log.recent().collect() == []
    assert log.start("full") == 1
    row = log.recent().first()
    assert (row.run_id, row.status, row.mode) == (1, "running", "full")
    assert row.started_at is not None and row.finished_at is None
    assert row.duration_seconds is None and row.phase_timings == {}


def test_a_run_ends_once_and_is_counted(log):
    nightly = log.start("full")
    hourly = log.start("incremental")
    log.finish(nightly, "failed", error_message="disk quota of node 7 used up")
    log.finish(hourly, "success", quality_score=88.25,
               phase_timings={"validate": 1.75, "analyze": 3.5, "load": 0.125},
               row_counts={"dim_supplier": 41, "raw_orders": 902})
    log.start("incremental")
    by_id = {r.run_id: r for r in log.recent().collect()}
    assert list(by_id) == [3, 2, 1]
    assert {k: r.status for k, r in by_id.items()} == {1: "failed", 2: "success", 3: "running"}
    assert by_id[1].error_message == "disk quota of node 7 used up" and by_id[1].quality_score is None
    good = by_id[2]
    assert good.mode == "incremental" and good.quality_score == 88.25
    assert good.row_counts == {"dim_supplier": 41, "raw_orders": 902}
    assert good.phase_timings["analyze"] == 3.5
    assert good.finished_at >= good.started_at and good.duration_seconds >= 0
    assert [r.run_id for r in log.recent(1).collect()] == [3]

    stats = reports.run_statistics(log.runs()).first().asDict()
    assert (stats["total_runs"], stats["success_runs"], stats["failed_runs"]) == (3, 1, 1)
    assert stats["success_rate"] == pytest.approx(100 / 3)
    assert reports.duration_trend(log.runs()).count() == 3
    # The latest run has no phases yet; the one before it has.
    assert reports.phase_breakdown(log.runs()).collect() == []
    ended = log.runs().filter("run_id = 2")
    phases = {r.phase: (r.run_id, r.seconds) for r in reports.phase_breakdown(ended).collect()}
    assert phases == {"validate": (2, 1.75), "analyze": (2, 3.5), "load": (2, 0.125)}


def test_without_runs(log):
    log.finish(31, "failed", error_message="never started")
    assert log.recent().collect() == []
    stats = reports.run_statistics(log.runs()).first()
    assert stats.total_runs == 0 and stats.success_rate == 0.0 and stats.avg_duration is None
    assert reports.duration_trend(log.runs()).collect() == []


def test_job_full_then_incremental(spark, data_dir, tmp_path, params):
    root = str(tmp_path / "wh")
    result = WarehouseJob(spark, root, data_dir=data_dir, params=params).run()
    assert set(result.phase_timings) == set(PHASES)
    assert result.failed_queries == {} and len(result.queries) == 15
    assert result.kpis["total_orders"] == 5 and result.quality["overall_score"] == 100.0
    expected = {
        "raw_orders": 6, "clean_orders": 5, "clean_customers": 4, "clean_products": 4,
        "clean_suppliers": 3, "clean_returns": 2, "clean_shipping": 5, "dim_date": 366,
        "fact_sales": 5,
    }
    assert expected.items() <= result.row_counts.items()

    with open(f"{data_dir}/raw/orders.csv", "a") as out:
        out.write("B-209,K17,A10,1,100.0,0,2024-12-01,completed\n")
        out.write("B-208,K17,A10,-1,100.0,0,2024-12-01,completed\n")
    job = WarehouseJob(spark, root, data_dir=data_dir, mode="incremental", params=params)
    result = job.run()
    assert result.new_facts == 1 and result.kpis["total_orders"] == 6
    assert job.warehouse.table("data_quality_issues").count() == 1
    assert result.row_counts["clean_orders"] == 1
    rows = job.run_log.recent().collect()
    assert [(r.run_id, r.status, r.mode) for r in rows] == [
        (2, "success", "incremental"), (1, "success", "full"),
    ]
    assert set(rows[0].phase_timings) == set(PHASES)
    assert rows[0].quality_score < 100


def test_failed_job_is_recorded(spark, tmp_path):
    job = WarehouseJob(spark, str(tmp_path / "wh"), data_dir=str(tmp_path / "none"))
    with pytest.raises(Exception, match="(?i)not.exist|not_found"):
        job.run()
    row = job.run_log.recent().first()
    assert row.status == "failed" and row.error_message


def test_run_log_fault_does_not_stop_the_job(spark, data_dir, tmp_path, params, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(RunLog, "start", broken)
    job = WarehouseJob(spark, str(tmp_path / "wh"), data_dir=data_dir, params=params)
    assert job.run().kpis["total_orders"] == 5


def test_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        WarehouseJob(spark, str(tmp_path))
    with pytest.raises(ValueError):
        WarehouseJob(spark, str(tmp_path), data_dir="x", mode="delta")
