"""Sources, sinks, retention and logs."""

from pyspark.sql import functions as F

from scholaris.operators import incremental, reports, star
from scholaris.operators.integrity import row_counts
from scholaris.plans import batch
from scholaris.plans.catalog import EXAMPLE_SALT, Tables, query
from scholaris.plans.quality_queries import CHECKS, GATE, POST_LOAD
from scholaris.settings import RETENTION_DAYS
from scholaris.sources import clustering, files, landing, quarantine, versions
from scholaris.sources.derived import SOURCES
from scholaris.sources.workspace import new_path, stored

C = F.col
_ALL_STAGING = ("students", "faculty", "grants", "courses", "enrollments")


def _counts_sql(names):
    return " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in names)


@query("csv_roundtrip", "select * from students")
def csv_roundtrip(t: Tables):
    path = new_path(t.spark, "students-csv")
    files.write_csv(t.students, path)
    return files.read_csv(t.spark, "students", path)


@query(
    "extraction_stats",
    _counts_sql(_ALL_STAGING) + f" union all select 'all', cast(sum(row_count) as bigint) from ({_counts_sql(_ALL_STAGING)}) c",
)
def extraction_stats(t: Tables):
    return files.extraction_stats(t.all())


@query("staging_load_counts", _counts_sql(_ALL_STAGING))
def staging_load_counts(t: Tables):
    return row_counts(files.load_staging(t.all(), new_path(t.spark, "staging")))


@query("staging_with_load_ts", "select *, timestamp '2024-01-31 06:30:00' as load_timestamp from enrollments")
def staging_with_load_ts(t: Tables):
    return files.with_load_timestamp(t.enrollments, F.lit("2024-01-31 06:30:00").cast("timestamp_ntz"))


_GIVEN = (*SOURCES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("table_row_counts", _counts_sql(_GIVEN))
def table_row_counts(t: Tables):
    return row_counts({name: t.spark.read.parquet(f"{t.directory}/{name}.parquet") for name in _GIVEN})


@query("run_query_capped", "select student_id, gpa from students where gpa >= 3.0 order by gpa desc, student_id limit 100")
def run_query_capped(t: Tables):
    text = "select student_id, gpa from {students} where gpa >= 3.0 order by gpa desc, student_id"
    return files.run_query(t.spark, text, max_results=100, students=t.students)


@query("partitioned_fact_scan", "select * from fact_enrollment where academic_year = 2018")
def partitioned_fact_scan(t: Tables):
    path = new_path(t.spark, "fact-by-year")
    fact = t.fact_enrollment
    files.write_partitioned(fact, path, "academic_year", ["student_key", "enrollment_key"])
    written = t.spark.read.schema(fact.schema).parquet(path)
    return written.filter(C("academic_year") == 2018)


@query(
    "grants_by_year_and_department",
    """select g.grant_id, g.award_amount, g.funding_agency, g.publication_count, year(g.start_date) as award_year, f.department
       from grants g join faculty f on g.pi_id = f.faculty_id where year(g.start_date) = 1996 and f.department = 'NATION_3'""",
)
def grants_by_year_and_department(t: Tables):
    """One department's grants of one year, from folders by both."""
    kept = ["grant_id", "award_amount", "funding_agency", "publication_count"]
    rows = t.staged_grants_by_department.select(*kept, F.year("start_date").cast("long").alias("award_year"), "department")
    path = new_path(t.spark, "grants-by-year")
    files.write_partitioned(rows, path, ["award_year", "department"], ["grant_id"])
    written = t.spark.read.schema(rows.schema).parquet(path)
    return written.filter((C("award_year") == 1996) & (C("department") == "NATION_3"))


_SUMMARY = """select s.major, e.year as academic_year, count(*) as total_enrollments, round(avg(e.grade_point), 6) as avg_gpa
              from enrollments e join students s using (student_id) where {} group by 1, 2"""


@query(
    "refresh_summary_partition",
    _SUMMARY.format("e.grade <> 'F' and e.year <> 2020") + " union all " + _SUMMARY.format("e.year = 2020"),
)
def refresh_summary_partition(t: Tables):
    """A summary built without F grades, of which one year is refreshed with all rows."""
    rows = t.known_enrollments
    path = new_path(t.spark, "summary")
    summary = reports.enrollment_summary(rows.filter(C("grade") != "F"))
    files.refresh_partitions(summary, path, "academic_year")
    files.refresh_partitions(reports.enrollment_summary(rows.filter(C("academic_year") == 2020)), path, "academic_year")
    return t.spark.read.schema(summary.schema).parquet(path)


@query("clustered_fact_scan", "select * from enrollments where course_id = 'CRS_00000123' or student_id = 'STU_00000077'")
def clustered_fact_scan(t: Tables):
    """Enrollments in files clustered on student and course, read by either."""
    rows, path = t.landed().enrollments, new_path(t.spark, "clustered")
    clustering.write_clustered(rows, path, ["student_id", "course_id"])
    written = t.spark.read.schema(rows.schema).parquet(path)
    return written.where((C("course_id") == "CRS_00000123") | (C("student_id") == "STU_00000077"))


_BAD_CREDITS, _BAD_LENGTH = "cohort_year = 1990", "cohort_year <> 1990 and gpa = 4.5"


@query(
    "quarantined_lines",
    f"""select student_id, case when {_BAD_CREDITS} then 'credits_completed is no bigint: many'
                                when {_BAD_LENGTH} then 'not 10 values' end as fault from students""",
)
def quarantined_lines(t: Tables):
    """Students from CSV with bad lines: every student, with what is wrong with the line."""
    path = new_path(t.spark, "inbox")
    spoilt = t.students.withColumn(
        "credits_completed", F.when(F.expr(_BAD_CREDITS), "many").otherwise(C("credits_completed").cast("string"))
    )
    end = F.when(F.coalesce(F.expr(_BAD_LENGTH), F.lit(False)), ",more").otherwise("")
    lines = spoilt.select(F.concat(F.to_csv(F.struct(*t.students.columns)), end).alias("value"))
    # The first line of a file is its header.
    files.write_lines(lines, path, ",".join(t.students.columns))
    found = quarantine.read_checked(t.spark, "students", path)
    good = found.good.select("student_id", F.lit(None).cast("string").alias("fault"))
    bad = found.bad.select(F.split("line", ",")[0].alias("student_id"), F.array_join("faults", "; ").alias("fault"))
    return good.unionByName(bad)


@query("retention_purge", "select * from events where ts >= (select max(ts) from events) - interval 7 day")
def retention_purge(t: Tables):
    events = t.source("events")
    latest = events.agg(F.max("ts")).scalar()
    return files.purge(events, new_path(t.spark, "events"), "ts", latest, RETENTION_DAYS["staging"])


@query("retention_by_day", "select * from events where ts >= (select max(ts) from events) - interval 7 day")
def retention_by_day(t: Tables):
    """Retention on a landing zone in folders by day: whole days go unread."""
    events, path = t.source("events"), new_path(t.spark, "landing")
    landing.land(events, path, "ts")
    latest = events.agg(F.max("ts")).first()[0]
    landing.purge(t.spark, path, events.schema, "ts", latest, RETENTION_DAYS["staging"])
    return landing.read(t.spark, path, events.schema)


# The day before which students are in the first of two loads.
_SECOND_LOAD = "2021-01-01"


@query("published_version_rows", "select * from students")
def published_version_rows(t: Tables):
    """Students of the published version, after an older one and beside one that is not published."""
    root = new_path(t.spark, "warehouse")
    early = t.students.where(C("date_enrolled") < _SECOND_LOAD)
    for name, rows, published in (("first", early, True), ("second", t.students, True), ("broken", early, False)):
        version = versions.begin(t.spark, root, name)
        files.saved(rows, f"{versions.folder(root, version)}/staging/students")
        if published:
            versions.publish(t.spark, root, version, ("staging",))
    return t.spark.read.schema(t.students.schema).parquet(f"{batch.layer(t.spark, root, 'staging')}/students")


@query(
    "dim_student_stable_keys",
    f"""select row_number() over (order by date_enrolled >= date '{_SECOND_LOAD}', student_id) as student_key,
               student_id, major, gpa, true as dw_is_current from students""",
)
def dim_student_stable_keys(t: Tables):
    """The dimension after a second load, whose new ids lie between those of the first."""
    registry = new_path(t.spark, "registry")
    star.lasting_students(t.students.where(C("date_enrolled") < _SECOND_LOAD), registry, "1")
    return star.lasting_students(t.students, registry, "2")


@query(
    "summary_delta_merge",
    """select s.major, e.year as academic_year, count(*) as total_enrollments, round(avg(e.grade_point), 6) as avg_gpa,
              round(stddev_samp(e.grade_point), 6) as sd_gpa
       from enrollments e join students s using (student_id) group by 1, 2""",
)
def summary_delta_merge(t: Tables):
    """A summary of yesterday's rows, brought up to date by the change feed.

    Yesterday the last fall term was missing, B grades were lower by half a point, and
    spring rows stood there a second time.
    """
    after_columns = ["enrollment_id", "major", "academic_year", "grade_point"]
    # The outcome of the joins is read several times: written down once, in the columns it takes.
    rows = stored(t.known_enrollments.select(*after_columns, "grade", "semester"), "known")
    after = rows.select(after_columns)
    last = rows.agg(F.max("academic_year")).scalar()
    lower = F.when(C("grade").startswith("B"), C("grade_point") - 0.5).otherwise(C("grade_point"))
    before = rows.where((C("academic_year") < last) | (C("semester") != "Fall")).withColumn("grade_point", lower)
    before = before.select(after_columns).unionByName(rows.where(C("semester") == "Spring").select(after_columns))
    groups, value = ["major", "academic_year"], "grade_point"
    summary = stored(incremental.states(before, groups, value), "summary")
    feed = stored(incremental.change_feed(before, after), "feed")
    return incremental.summarized(incremental.refreshed(summary, feed, groups, value), groups)


_BUILT = {
    **{n: n for n in ("dim_student", "dim_faculty", "fact_enrollment", "fact_research_grant")},
    "dim_course": "courses",
    "dim_department": "(select distinct department from faculty)",
    "dim_funding_agency": "(select distinct funding_agency from grants)",
    "dim_date": "(select distinct date_enrolled, cohort_year from students)",
    "fact_student_performance": """(select distinct student_id, year from enrollments
                                   where student_id in (select student_id from students))""",
    "fact_faculty_productivity": "faculty",
    "fact_course_performance": "courses",
}
_LOADED = " + ".join(f"(select count(*) from {n})" for n in _ALL_STAGING)
_POST = f"(select count(*) as checks, count(*) filter (where status = 'PASS') as passed from ({POST_LOAD}) p)"
_RUN = f"""
select 'registered' as run_id, cast(step as int) as step, phase, status, cast(tables as bigint) as tables, cast(n as bigint) as rows
from (select 1 as step, 'extract' as phase, 'PASS' as status, 5 as tables, {_LOADED} as n
      union all select 2, 'validate', max(case when status = 'FAIL' then 'FAIL' else 'PASS' end), count(*), sum(passed)
                from ({GATE}) g where table_name <> 'all'
      union all select 3, 'transform', 'PASS', {len(_BUILT)}, {" + ".join(f"(select count(*) from {n} t)" for n in _BUILT.values())}
      union all select 4, 'post_check', case when passed < checks then 'FAIL' else 'PASS' end, 2, checks + passed from {_POST} c
      union all select 5, 'load', 'PASS', 5, {_LOADED}
      union all select 6, 'end', 'WARN', 0, 0) l"""


@query("run_log", _RUN)
def run_log(t: Tables):
    """The phases of a whole run, without what differs from run to run."""
    log = batch.run(t.spark, t.all(), new_path(t.spark, "run"), EXAMPLE_SALT, run_id="registered")
    return log.select("run_id", "step", "phase", "status", "tables", "rows")


@query("quality_log", f"select *, 'registered' as run_id from ({CHECKS}) c")
def quality_log(t: Tables):
    return batch.quality_log(t.landed().checks, run_id="registered").drop("logged_at")


@query(
    "stage_lineage_counts",
    """select 'dim_student' as target, 'students' as source, count(*) as rows_in, count(*) as rows_out,
              cast(0 as bigint) as rows_dropped from students
       union all select 'dim_faculty', 'faculty', count(*), count(*), 0 from faculty
       union all select 'dim_course', 'courses', count(*), count(*), 0 from courses
       union all select 'fact_enrollment', 'enrollments', count(*), (select count(*) from fact_enrollment),
                        count(*) - (select count(*) from fact_enrollment) from enrollments
       union all select 'fact_research_grant', 'grants', count(*), (select count(*) from fact_research_grant),
                        count(*) - (select count(*) from fact_research_grant) from grants""",
)
def stage_lineage_counts(t: Tables):
    return batch.stage_lineage(t.all())
