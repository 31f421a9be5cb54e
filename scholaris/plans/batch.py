"""The batch run: extract, validate, load, transform, check, and a log of it all.

Everything is built as a new version beside the one in use, and published by one step at
the end, once all checks have had their say: a run that stops or breaks, wherever it does,
leaves the last good version as it was, whole. Each phase reads what the phase before it
wrote, so wide work is done once and a lost executor costs a re-read. Phases are logged as
rows; an error ends the run and is raised after the log has been written.
"""

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris import settings
from scholaris.functions.numeric import map_total
from scholaris.operators import integrity, quality, reports, star, views
from scholaris.operators.ranking import positioned
from scholaris.sources import files, versions
from scholaris.sources.workspace import children, in_turn, intermediate_tables, replace_folder, together

C = F.col
ENTRY = "run_id string, step int, phase string, status string, detail map<string,long>, error string, logged_at timestamp"
LOG_SCHEMA = (
    "run_id string, step int, phase string, status string, tables long, rows long, "
    "detail map<string,long>, error string, logged_at timestamp"
)
LOG_COLUMNS = [part.split()[0] for part in LOG_SCHEMA.split(", ")]
LAYERS = ("staging", "analytics", "compliance")


class RunLog:
    """Phases of one run, in order."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id, self.entries, self.phase = spark, run_id, [], "extract"

    def add(self, phase: str, status: str, detail: dict[str, int] | None = None, error: str | None = None) -> None:
        now = datetime.now(timezone.utc)
        step = len(self.entries) + 1
        self.entries.append((self.run_id, step, phase, status, detail or {}, error, now))

    @property
    def failed(self) -> list[str]:
        return [e[2] for e in self.entries if e[3] == "FAIL"]

    def write(self, path: str) -> None:
        rows = self.spark.createDataFrame(self.entries, ENTRY).coalesce(1)
        sums = {"tables": F.size("detail").cast("long"), "rows": map_total("detail")}
        rows.withColumns(sums).select(LOG_COLUMNS).write.mode("append").json(path)

    def read(self, path: str) -> DataFrame:
        """The run's rows as they were written, and none of an earlier run of the same name."""
        rows = self.spark.read.schema(LOG_SCHEMA).json(path).where(C("run_id") == self.run_id)
        started = self.entries[0][-1].replace(microsecond=0)  # JSON keeps milliseconds
        return rows.where(C("logged_at") >= F.lit(started)).orderBy("step")


class QualityGateError(RuntimeError):
    """Raised where a run is told to stop on failed checks."""


def _saved(df: DataFrame, path: str) -> DataFrame:
    return files.saved(df, path)[0]


def quality_log(checks: DataFrame, run_id: str) -> DataFrame:
    return checks.withColumn("run_id", F.lit(run_id)).withColumn("logged_at", F.current_timestamp())


def retained(tables: dict[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """The tables without records older than their kind is kept; records without the date stay."""
    kept = dict(tables)
    for name, (kind, column) in settings.RECORD_DATES.items():
        if name in kept:
            moment = F.lit(as_of).cast("timestamp")
            kept[name] = files.kept(kept[name], column, moment, settings.RETENTION_DAYS[kind])
    return kept


def purge_logs(spark: SparkSession, directory: str, as_of: datetime) -> None:
    """Delete log rows older than logs are kept."""
    path, moment = f"{directory}/logs/runs", F.lit(as_of).cast("timestamp")
    rows = spark.read.schema(LOG_SCHEMA).json(path)
    left = files.kept(rows, "logged_at", moment, settings.RETENTION_DAYS["pipeline_logs"])
    # Written beside the log and put in its place: rows are not read while they are replaced.
    left.write.mode("overwrite").json(f"{path}-kept")
    replace_folder(spark, f"{path}-kept", path)


def run(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    directory: str,
    salt: str,
    run_id: str,
    as_of: date = settings.AS_OF,
    on_fail: str = "warn",
    nullable: tuple[str, ...] = (),
    load_only: bool = False,
    retain: bool = False,
) -> DataFrame:
    """Run all phases over the source tables into `directory`; returns the run log as written.

    Empty sources and failed checks, before or after the star schema is built, are logged:
    with `on_fail` "warn" the run goes on and ends with WARN, with "stop" it ends with FAIL
    and leaves the version of the last run in use; so does any error, which is logged with
    its phase. A version has the layers staging, analytics and compliance, whose folders
    `layer` names; logs and the registry of keys lie beside the versions. Dimension keys
    stay from run to run. `load_only` ends after loading, the other layers stay those in
    use. `retain` leaves records out that are older than their kind is kept, and log rows
    likewise. The version before the new one is kept for readers that are still at it;
    older ones, and what broken runs left, are deleted. The salt is never logged.
    """
    if on_fail not in ("warn", "stop"):
        raise ValueError("on_fail is 'warn' or 'stop'")
    log, logs, error = RunLog(spark, run_id), f"{directory}/logs/runs", None
    try:
        with intermediate_tables(spark):
            _phases(log, retained(tables, as_of) if retain else tables, directory, salt, as_of, on_fail, nullable, load_only)
        if retain and children(spark, logs):
            purge_logs(spark, directory, datetime.combine(as_of, datetime.min.time()))
        log.add("end", "WARN" if log.failed else "PASS")
    except Exception as caught:
        error = caught
        if not isinstance(caught, QualityGateError):
            log.add(log.phase, "FAIL", error=f"{type(caught).__name__}: {str(caught)[:500]}")
        log.add("end", "FAIL", error=f"{log.phase} failed")
    try:
        log.write(logs)
    except Exception as unwritten:
        if error is None:
            raise
        error.add_note(f"the run log could not be written: {unwritten}")
    if error is not None:
        raise error
    return log.read(logs)


def _phases(log, tables, directory, salt, as_of, on_fail, nullable, load_only) -> None:
    version = versions.begin(log.spark, directory, log.run_id)
    building = versions.folder(directory, version)

    def verdict(phase: str, failed: list[str], detail: dict[str, int]) -> None:
        reason = ", ".join(sorted(failed))
        log.add(phase, "FAIL" if failed else "PASS", detail, f"failed: {reason}" if failed else None)
        if failed and on_fail == "stop":
            raise QualityGateError(f"{phase} failed: {reason}")

    # Sources are written down once; nothing reads them again.
    landed, counts = files.load_counted(tables, f"{building}/staging")
    staged = {name: df.drop("load_timestamp") for name, df in landed.items()}
    verdict("extract", [name for name, n in counts.items() if not n], counts)

    log.phase = "validate"
    checks = _saved(
        quality_log(quality.report(staged, as_of, nullable), log.run_id),
        f"{directory}/logs/quality/run_id={log.run_id}",
    )
    gate = {r["table_name"]: r for r in quality.gate(checks).collect() if r["table_name"] != quality.ALL}
    verdict("validate", [n for n, r in gate.items() if r["status"] == "FAIL"], {n: r["passed"] for n, r in gate.items()})

    if load_only:
        log.phase = "load"
        _publish(log, directory, version, ("staging",))
        log.add("load", "PASS", counts)
        return

    log.phase = "transform"
    built, rows = transform(staged, f"{building}/analytics", f"{directory}/registry", version)
    publish(built, staged, f"{building}/compliance", salt)
    log.add("transform", "PASS", rows)
    flows = [(target, source, counts[source], rows[target], counts[source] - rows[target]) for target, source in STAR_SOURCES.items()]
    lineage = quality_log(log.spark.createDataFrame(flows, LINEAGE), log.run_id)
    lineage.write.mode("overwrite").parquet(f"{directory}/logs/lineage/run_id={log.run_id}")

    log.phase = "post_check"
    post = integrity.post_load(built["fact_enrollment"], built["dim_student"], staged)
    post = _saved(quality_log(post, log.run_id), f"{directory}/logs/post_load/run_id={log.run_id}")
    failed = {r["check_name"]: r for r in post.filter(C("status") != "PASS").collect()}
    passed = integrity.pass_counts(post).first()
    verdict("post_check", list(failed), {"checks": passed["checks"], "passed": passed["passed"]})

    log.phase = "load"
    _publish(log, directory, version, LAYERS)
    log.add("load", "PASS", counts)


def _publish(log: RunLog, directory: str, version: str, layers: tuple[str, ...]) -> None:
    versions.publish(log.spark, directory, version, layers)
    versions.retire(log.spark, directory)


def layer(spark: SparkSession, directory: str, name: str) -> str:
    """The folder of a layer of the version in use."""
    return versions.layers(spark, directory)[name]


def transform(staged: dict[str, DataFrame], directory: str, registry: str, load: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Build and save the star schema, dimensions before the facts that use them, the rest at the same time.

    Returns the tables and their rows, counted as they were written.
    """
    s, built, rows = staged, {}, {}

    def placed(name: str) -> DataFrame:
        return positioned(staged[name], in_files=True)

    def save(name: str, build: Callable[[], DataFrame]) -> Callable[[], None]:
        def work() -> None:
            built[name], rows[name] = files.saved(build(), f"{directory}/{name}")

        return work

    def save_enrollments() -> None:
        fact = star.fact_enrollment(placed("enrollments"), built["dim_student"])
        path = f"{directory}/fact_enrollment"
        rows["fact_enrollment"] = files.write_partitioned(fact, path, "academic_year", ["student_key", "enrollment_key"])
        built["fact_enrollment"] = fact.sparkSession.read.schema(fact.schema).parquet(path)

    save_grants = save("fact_research_grant", lambda: star.fact_research_grant(placed("grants"), built["dim_faculty"]))
    apart = {
        "dim_student": save("dim_student", lambda: star.lasting_students(s["students"], f"{registry}/student", load)),
        "dim_faculty": save("dim_faculty", lambda: star.lasting_faculty(s["faculty"], f"{registry}/faculty", load)),
        "dim_course": save("dim_course", lambda: star.lasting_courses(s["courses"], f"{registry}/course", load)),
        "dim_department": save("dim_department", lambda: star.dim_department(s["faculty"])),
        "dim_funding_agency": save("dim_funding_agency", lambda: star.dim_funding_agency(s["grants"])),
        "dim_date": save("dim_date", lambda: star.dim_date(s["students"])),
        "fact_student_performance": save(
            "fact_student_performance", lambda: star.fact_student_performance(s["enrollments"], s["students"])
        ),
        "fact_faculty_productivity": save(
            "fact_faculty_productivity", lambda: star.fact_faculty_productivity(s["faculty"], s["grants"], s["courses"])
        ),
        "fact_course_performance": save(
            "fact_course_performance", lambda: star.fact_course_performance(s["courses"], s["enrollments"])
        ),
    }
    # What no other table waits for runs beside the dimensions and their facts.
    together(apart | {"dim_student": in_turn(apart["dim_student"], save_enrollments), "dim_faculty": in_turn(apart["dim_faculty"], save_grants)})
    return built, rows


def publish(built: dict[str, DataFrame], staged: dict[str, DataFrame], directory: str, salt: str) -> None:
    """Save the governed outputs and the summary that dashboards read."""

    def rows() -> None:
        whole = views.fact_rows(built["fact_enrollment"], built["dim_student"])
        safe = _saved(views.student_enrollment_safe(whole, salt), f"{directory}/student_enrollment_safe")
        _saved(reports.enrollment_summary(safe), f"{directory}/enrollment_summary")

    sums = views.fact_grant_sums(built["fact_research_grant"], built["dim_faculty"])
    others = {
        "faculty_research_safe": views.faculty_research_safe(sums),
        "student_masked": views.student_masked(staged["students"], salt),
        "faculty_masked": views.faculty_masked(staged["faculty"], salt),
    }
    together({"rows": rows} | {name: partial(_saved, df, f"{directory}/{name}") for name, df in others.items()})


# The star tables that take their rows from one source each.
STAR_SOURCES = {
    "dim_student": "students",
    "dim_faculty": "faculty",
    "dim_course": "courses",
    "fact_enrollment": "enrollments",
    "fact_research_grant": "grants",
}
LINEAGE = "target string, source string, rows_in long, rows_out long, rows_dropped long"


def stage_lineage(staged: dict[str, DataFrame]) -> DataFrame:
    """What the star takes from staging: rows in the source, rows in the target, and the difference.

    Dimensions take every row. Facts are inner joins, whose rows are counted per key on
    either side and never built.
    """
    joins = {
        "fact_enrollment": ("student_id", "students", "student_id"),
        "fact_research_grant": ("pi_id", "faculty", "faculty_id"),
    }

    def flow(target: str, source: str) -> DataFrame:
        if target in joins:
            column, parent, key = joins[target]
            counts = integrity.join_flow(staged[source], column, staged[parent], key)
        else:
            counts = staged[source].agg(F.count("*").alias("rows_in")).withColumn("rows_out", C("rows_in"))
        names = [F.lit(target).alias("target"), F.lit(source).alias("source")]
        return counts.select(*names, "rows_in", "rows_out", (C("rows_in") - C("rows_out")).alias("rows_dropped"))

    return quality.union([flow(target, source) for target, source in STAR_SOURCES.items()])
