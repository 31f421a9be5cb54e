"""Files, retention, partition refresh and the batch run."""

import json
import threading
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from scholaris.operators import reports
from scholaris.plans import batch
from scholaris.plans.catalog import QUERIES, Tables, load
from scholaris.schemas import STAGING
from scholaris.sources.workspace import children
from scholaris.sources import files, versions, workspace

load()
SMALL = "/root/testdata/sf0.001"


def test_csv_keeps_types_nulls_and_quotes(spark, tmp_path):
    rows = [
        ("F1", 'He said "x", twice', date(2020, 1, 2), None, 5, "Active", "a\nb", ""),
        ("F2", None, None, "D", None, None, None, " "),
    ]
    df = spark.createDataFrame(rows, STAGING["faculty"])
    files.write_csv(df, str(tmp_path / "f"))
    back = files.read_csv(spark, "faculty", str(tmp_path / "f"), multiline=True)
    assert back.schema == STAGING["faculty"]
    # CSV cannot tell an empty value from a missing one.
    want = df.withColumn("research_focus", F.nullif("research_focus", F.lit("")))
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))


def test_loading_turns_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "gpa double, id long")
    loaded = files.load_staging({"t": df}, str(tmp_path))["t"]
    assert sorted((r.id, r.gpa) for r in loaded.collect()) == [(1, None), (2, 2.0)]
    assert loaded.filter("load_timestamp is null").count() == 0


def test_malformed_csv_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(",".join(STAGING["faculty"].names) + "\nF1,r,2020-01-01,d,lots,a,t,r\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_csv(spark, "faculty", str(tmp_path / "bad.csv")).collect()


def test_refresh_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.refresh_partitions(spark.createDataFrame([(1, "old"), (2, "old")], "y int, v string"), path, "y")
    files.refresh_partitions(spark.createDataFrame([(2, "new")], "y int, v string"), path, "y")
    assert sorted((r.y, r.v) for r in spark.read.parquet(path).collect()) == [(1, "old"), (2, "new")]


def test_partitioned_scan_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).select((F.col("id") % 4).alias("year"), "id")
    files.write_partitioned(df, path, "year", ["id"])
    one = spark.read.parquet(path).filter("year = 2")
    assert one.count() == 250
    read = [r.f for r in one.select(F.input_file_name().alias("f")).distinct().collect()]
    assert read and all("year=2" in f for f in read)
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_folders_by_two_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).selectExpr("id % 4 as year", "concat('d ', id % 3) as department", "id")
    assert files.write_partitioned(df, path, ["year", "department"], ["id"]) == 1000
    one = spark.read.schema(df.schema).parquet(path).filter("year = 2 and department = 'd 1'")
    assert sorted(r.id for r in one.collect()) == [i for i in range(1000) if i % 4 == 2 and i % 3 == 1]
    read = [r.f for r in one.select(F.input_file_name().alias("f")).distinct().collect()]
    assert read and all("year=2/department=d%201" in f for f in read)


def test_retention_keeps_the_boundary_and_undated_rows(spark, tmp_path):
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 1, 8),), (datetime(2023, 12, 31, 23),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    as_of = F.lit("2024-01-08").cast("timestamp_ntz")
    left = files.purge(df, str(tmp_path / "r"), "ts", as_of, 7)
    assert sorted(str(r.ts) for r in left.collect()) == ["2024-01-01 00:00:00", "2024-01-08 00:00:00", "None"]


def test_capped_query(spark):
    frame = spark.range(50)
    assert files.run_query(spark, "select id from {t} order by id desc", 3, t=frame).count() == 3
    assert files.run_query(spark, "select id from {t}", t=spark.range(150_000)).count() == 150_000


def test_views_are_replaced_and_counted(spark):
    files.register_views({"numbers": spark.range(3)})
    files.register_views({"numbers": spark.range(5)})
    assert files.table_row_count(spark, "numbers") == 5


@pytest.mark.parametrize("name", sorted(STAGING))
def test_staging_tables_have_the_declared_columns(spark, name):
    derived = getattr(Tables(spark, SMALL), name)
    assert derived.dtypes == [(f.name, f.dataType.simpleString()) for f in STAGING[name].fields]


def test_workspace_is_shared_or_local(spark):
    assert spark.conf.get("spark.app.id") in workspace.workspace(spark)


def test_intermediate_tables_go_with_their_block(spark):
    outside = workspace.stored(spark.range(3), "kept")
    with workspace.intermediate_tables(spark):
        inside = workspace.stored(spark.range(4), "dropped")
        (folder,) = {str(Path(f).parent) for f in inside.inputFiles()}
        assert inside.count() == 4
    assert not Path(folder.removeprefix("file:")).exists()
    assert outside.count() == 3


def session_of(master, folder=None):
    settings = {"spark.app.id": f"app-{master}", "spark.master": master, "spark.checkpoint.dir": folder}

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return settings.get(key) or default

    return Session


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077", ""])
def test_workspace_demands_a_shared_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.workspace(session_of(master))
    assert workspace.workspace(session_of(master, "hdfs://x/y/")).startswith("hdfs://x/y/scholaris/")


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_has_one_temporary_folder(master):
    first, second = (workspace.workspace(session_of(master)) for _ in range(2))
    assert first == second


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("run"))
    log = batch.run(spark, Tables(spark, SMALL).all(), directory, "secret-salt", run_id="r1")
    return directory, log.collect()


def test_run_logs_every_phase(finished):
    directory, log = finished
    assert [r.phase for r in log] == ["extract", "validate", "transform", "post_check", "load", "end"]
    status = {r.phase: r.status for r in log}
    assert status["end"] == "WARN" and status["validate"] == "FAIL" and status["load"] == "PASS"
    assert "students" in next(r.error for r in log if r.phase == "validate")
    assert next(r.detail for r in log if r.phase == "post_check")["checks"] == 6
    written = [json.loads(line) for f in Path(directory, "logs/runs").glob("*.json") for line in f.read_text().splitlines()]
    assert len(written) == len(log)
    assert "secret-salt" not in json.dumps(written)


def test_run_builds_the_same_star_as_the_queries(spark, finished):
    directory, _ = finished
    for name in ("dim_student", "fact_enrollment", "fact_research_grant", "dim_course"):
        built = spark.read.parquet(f"{batch.layer(spark, directory, 'analytics')}/{name}")
        queried = QUERIES[name](spark, SMALL)
        assert built.select(queried.columns).exceptAll(queried).count() == 0
        assert built.count() == queried.count()


def test_run_keeps_years_apart(spark, finished):
    directory, _ = finished
    assert list(Path(batch.layer(spark, directory, "analytics"), "fact_enrollment").glob("academic_year=*"))


def test_published_rows_hold_no_raw_id(spark, finished):
    directory, _ = finished
    for name in ("student_enrollment_safe", "student_masked", "faculty_masked", "faculty_research_safe", "enrollment_summary"):
        df = spark.read.parquet(f"{batch.layer(spark, directory, 'compliance')}/{name}")
        text = df.select(F.to_json(F.struct("*")).alias("j"))
        assert df.count() > 0
        assert text.filter(F.col("j").rlike("STU_|FAC_|GNT_|ENR_")).count() == 0, name


def test_safe_view_matches_its_summary(spark, finished):
    directory, _ = finished
    safe = spark.read.parquet(f"{batch.layer(spark, directory, 'compliance')}/student_enrollment_safe")
    summary = spark.read.parquet(f"{batch.layer(spark, directory, 'compliance')}/enrollment_summary")
    total = summary.agg(F.sum("total_enrollments")).collect()[0][0]
    assert total == safe.count() and reports.enrollment_summary(safe).count() == summary.count()


def log_of(directory):
    lines = [json.loads(x) for f in Path(directory, "logs/runs").glob("*.json") for x in f.read_text().splitlines()]
    return sorted(lines, key=lambda x: (x["logged_at"], x["step"]))


@pytest.fixture
def layers(spark, tmp_path):
    """A directory with layers from an earlier run."""
    version = versions.begin(spark, str(tmp_path), "old")
    for layer in batch.LAYERS:
        folder = Path(versions.folder(str(tmp_path), version), layer)
        folder.mkdir(parents=True)
        (folder / "old").write_text("old")
    versions.publish(spark, str(tmp_path), version, batch.LAYERS)
    return tmp_path


def untouched(directory):
    found = versions.layers(SparkSession.active(), str(directory))
    return len(found) == 3 and all(Path(folder, "old").read_text() == "old" for folder in found.values())


def test_stop_leaves_the_layers_of_the_last_run(spark, layers):
    with pytest.raises(batch.QualityGateError):
        batch.run(spark, Tables(spark, SMALL).all(), str(layers), "s", run_id="r2", on_fail="stop")
    assert untouched(layers)
    assert [(x["phase"], x["status"]) for x in log_of(layers)][-2:] == [("validate", "FAIL"), ("end", "FAIL")]


def test_an_empty_source_stops_a_strict_run(spark, layers):
    tables = Tables(spark, SMALL).all()
    with pytest.raises(batch.QualityGateError, match="courses"):
        batch.run(spark, tables | {"courses": tables["courses"].limit(0)}, str(layers), "s", run_id="r5", on_fail="stop")
    assert untouched(layers)


def test_a_failing_transform_is_named_in_the_log(spark, layers, monkeypatch):
    def broken(*_):
        raise ArithmeticError("no star today")

    monkeypatch.setattr(batch, "transform", broken)
    with pytest.raises(ArithmeticError):
        batch.run(spark, Tables(spark, SMALL).all(), str(layers), "s", run_id="r6")
    assert untouched(layers)
    entry = next(x for x in log_of(layers) if x["phase"] == "transform")
    assert entry["status"] == "FAIL" and "no star today" in entry["error"]


def test_failed_post_checks_stop_a_strict_run(spark, layers, monkeypatch):
    monkeypatch.setattr(batch.quality, "gate", lambda checks: checks.sparkSession.createDataFrame([], "table_name string, passed long, status string"))
    with pytest.raises(batch.QualityGateError, match="post_check"):
        batch.run(spark, Tables(spark, SMALL).all(), str(layers), "s", run_id="r7", on_fail="stop")
    assert untouched(layers)


def test_an_unwritten_log_does_not_hide_the_error(spark, layers, monkeypatch):
    def broken(*_):
        raise ArithmeticError("first")

    def unwritable(*_):
        raise OSError("second")

    monkeypatch.setattr(batch, "transform", broken)
    monkeypatch.setattr(batch.RunLog, "write", unwritable)
    with pytest.raises(ArithmeticError) as caught:
        batch.run(spark, Tables(spark, SMALL).all(), str(layers), "s", run_id="r8")
    assert any("second" in note for note in caught.value.__notes__)


def test_load_only_replaces_staging_alone(spark, layers):
    log = batch.run(spark, Tables(spark, SMALL).all(), str(layers), "s", run_id="r9", load_only=True).collect()
    assert [r.phase for r in log] == ["extract", "validate", "load", "end"]
    assert spark.read.parquet(batch.layer(spark, str(layers), "staging") + "/students").count() == 150
    assert not Path(batch.layer(spark, str(layers), "staging"), "old").exists()
    assert Path(batch.layer(spark, str(layers), "analytics"), "old").exists()


def test_retention_by_kind(spark):
    grants = spark.createDataFrame([("a", date(2010, 1, 1)), ("b", date(2020, 1, 1)), ("c", None)], "grant_id string, end_date date")
    students = spark.createDataFrame([("s", date(2010, 1, 1)), ("t", None)], "student_id string, date_graduated date")
    kept = batch.retained({"grants": grants, "students": students, "courses": grants}, date(2026, 7, 16))
    assert sorted(r.grant_id for r in kept["grants"].collect()) == ["b", "c"]
    assert [r.student_id for r in kept["students"].collect()] == ["t"] and kept["courses"].count() == 3


def test_old_log_rows_are_purged(spark, tmp_path):
    log = batch.RunLog(spark, "r10")
    log.add("extract", "PASS", {"t": 3})
    log.write(f"{tmp_path}/logs/runs")
    batch.purge_logs(spark, str(tmp_path), datetime.now() + timedelta(days=30))
    assert log.read(f"{tmp_path}/logs/runs").count() == 1
    batch.purge_logs(spark, str(tmp_path), datetime.now() + timedelta(days=90))
    assert log.read(f"{tmp_path}/logs/runs").count() == 0


def test_counts_of_the_log_are_those_of_the_files(spark, finished):
    directory, log = finished
    analytics = batch.layer(spark, directory, "analytics")
    found = {name: spark.read.parquet(f"{analytics}/{name}").count() for name in children(spark, analytics)}
    entry = next(r for r in log if r.phase == "transform")
    assert entry.detail == found and entry.tables == len(found) and entry.rows == sum(found.values())
    lineage = {r.target: r for r in spark.read.parquet(f"{directory}/logs/lineage").collect()}
    assert {name: r.rows_out for name, r in lineage.items()} == {name: found[name] for name in batch.STAR_SOURCES}


def test_keys_stay_from_run_to_run(spark, tmp_path):
    """Yesterday's fact points at the same people after a run that brings ids between the old ones."""
    tables, directory = Tables(spark, SMALL).all(), str(tmp_path)
    early = tables | {"students": tables["students"].filter("date_enrolled < date'2021-01-01'")}
    batch.run(spark, early, directory, "s", run_id="monday")
    monday = batch.layer(spark, directory, "analytics")
    people = spark.read.parquet(f"{monday}/fact_enrollment").select("student_key").distinct()
    named = people.join(spark.read.parquet(f"{monday}/dim_student"), "student_key").select("student_key", "student_id")
    before = {r.student_key: r.student_id for r in named.collect()}
    batch.run(spark, tables, directory, "s", run_id="tuesday")
    tuesday = batch.layer(spark, directory, "analytics")
    after = {r.student_key: r.student_id for r in spark.read.parquet(f"{tuesday}/dim_student").collect()}
    assert before and len(after) == 150 > len(before) and before.items() <= after.items()
    assert min(k for k in after if k not in before and after[k] < max(before.values())) > max(before)
    # Monday's version is still there for its readers; a third run leaves the last two.
    assert spark.read.parquet(f"{monday}/dim_student").count() > 0
    batch.run(spark, tables, directory, "s", run_id="wednesday", load_only=True)
    assert not Path(monday).exists() and Path(tuesday).exists()
    assert batch.layer(spark, directory, "analytics") == tuesday


def test_lineage_counted_on_staging_equals_the_run(spark, finished):
    directory, _ = finished
    staged = {n: spark.read.parquet(f"{batch.layer(spark, directory, 'staging')}/{n}") for n in STAGING}
    columns = ["target", "source", "rows_in", "rows_out", "rows_dropped"]
    rows = {tuple(r) for r in batch.stage_lineage(staged).select(columns).collect()}
    written = spark.read.parquet(f"{directory}/logs/lineage")
    assert rows == {tuple(r) for r in written.select(columns).collect()}
    dropped = {r[0]: r[4] for r in rows}
    assert dropped["fact_enrollment"] > 0 and dropped["dim_course"] == 0
    assert [r.run_id for r in written.select("run_id").distinct().collect()] == ["r1"]


def test_unknown_gate_mode_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        batch.run(spark, {}, str(tmp_path), "s", run_id="r3", on_fail="ignore")


def test_jobs_run_together_and_all_end(spark):
    meet, ended = threading.Barrier(2), []

    def fails():
        meet.wait(30)
        raise ArithmeticError("first")

    def works():
        meet.wait(30)
        ended.append(workspace.new_path(spark, "inside"))

    with workspace.intermediate_tables(spark):
        with pytest.raises(ArithmeticError):
            workspace.together({"a": fails, "b": works})
        assert len(ended) == 1 and workspace._scoped_paths.get() == ended
    assert workspace.together({}) == {} and workspace.together({"b": int, "a": str}) == {"b": 0, "a": ""}


def test_tables_do_not_wait_for_tables_they_do_not_need(spark, tmp_path, monkeypatch):
    """Sources land at the same time; facts that need no key are written beside the dimensions."""
    meet, write = threading.Barrier(2), files.saved

    def saved(df, path, by=None):
        if Path(path).name in ("students", "enrollments", "dim_student", "fact_course_performance"):
            meet.wait(60)
        return write(df, path, by)

    monkeypatch.setattr(files, "saved", saved)
    loaded, counts = files.load_counted(Tables(spark, SMALL).all(), f"{tmp_path}/staging")
    assert list(loaded) == list(counts) == list(STAGING) and counts["students"] == 150
    with workspace.intermediate_tables(spark):
        built, rows = batch.transform(loaded, f"{tmp_path}/analytics", f"{tmp_path}/registry", "1")
    assert rows == {name: df.count() for name, df in built.items()} and rows["dim_student"] == 150
