"""Dashboard figures and report queries."""

from scholaris.operators import reports
from scholaris.plans.catalog import Tables, query

# Agencies that occur in the derived grants.
AGENCIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "enrollment_by_major_year",
    """select major, academic_year, count(student_key) as total_students
       from dim_student join fact_enrollment using (student_key) group by 1, 2 order by 3 desc""",
)
def enrollment_by_major_year(t: Tables):
    return reports.enrollment_by_major_year(t.known_years)


@query(
    "cost_per_publication",
    """select department, sum(award_amount) / nullif(sum(publication_count), 0) as cost_per_pub
       from grants_by_department group by 1 order by 2 nulls first""",
)
def cost_per_publication(t: Tables):
    return reports.cost_per_publication(t.grant_sums)


@query("total_enrolled_students", "select count(distinct student_id) as total_students from enrollment_detail")
def total_enrolled_students(t: Tables):
    enrolled = t.enrollments.select("student_id").distinct()
    known = enrolled.join(t.students.select("student_id"), "student_id", "left_semi")
    return reports.total_students(known, "student_id")


@query(
    "avg_gpa_by_major",
    """select 'major' as scope, major, count(*) as students, round(avg(gpa), 6) as avg_gpa from students group by major
       union all select 'overall', null, count(*), round(avg(gpa), 6) from students""",
)
def avg_gpa_by_major(t: Tables):
    return reports.avg_gpa_by_major(t.students)


@query(
    "enrollment_by_year",
    "select academic_year, count(*) as enrollments from fact_enrollment group by academic_year",
)
def enrollment_by_year(t: Tables):
    return reports.enrollment_by_year(t.known_years)


@query(
    "students_by_major_share",
    """select major, count(*) as students, round(count(*) / (select count(*) from students)::double, 6) as share
       from students group by major""",
)
def students_by_major_share(t: Tables):
    return reports.students_by_major_share(t.students)


@query(
    "demographics",
    """select case when ethnicity in ('Asian', 'Black', 'Hispanic', 'Native American', 'Non-Resident Alien',
                                      'Two or More Races', 'White', 'Unknown') then ethnicity else 'Unknown' end as ethnicity,
              first_generation, count(*) as students
       from students group by 1, 2""",
)
def demographics(t: Tables):
    return reports.demographics(t.students)


@query("at_risk_students", "select student_id, major, cohort_year, gpa from students where gpa < 2.5")
def at_risk_students(t: Tables):
    return reports.at_risk_students(t.students)


@query("invalid_gpa_rows", "select student_id, major, gpa from students where gpa < 0.0 or gpa > 4.0")
def invalid_gpa_rows(t: Tables):
    return reports.invalid_gpa_rows(t.students)


@query(
    "research_totals",
    """select cast(sum(award_amount) as bigint) as total_awards,
              cast(sum(publication_count) as bigint) as total_publications from fact_research_grant""",
)
def research_totals(t: Tables):
    return reports.research_totals(t.grant_sums)


@query(
    "award_by_department",
    """select department, cast(sum(award_amount) as bigint) as award_amount,
              round(sum(award_amount) / (select sum(award_amount) from grants_by_department)::double, 6) as share
       from grants_by_department group by department""",
)
def award_by_department(t: Tables):
    return reports.award_by_department(t.grant_sums)


@query(
    "award_publication_corr",
    """select count(*) as grants, round(corr(award_amount, publication_count), 6) as correlation,
              round(regr_slope(publication_count, award_amount), 12) as publications_per_dollar
       from fact_research_grant""",
)
def award_publication_corr(t: Tables):
    return reports.award_publication_corr(t.staged_grants_by_department)


@query("award_publication_points", "select grant_id, award_amount, publication_count from fact_research_grant")
def award_publication_points(t: Tables):
    return reports.award_publication_points(t.staged_grants_by_department)


@query(
    "publications_per_dollar_by_agency",
    """select funding_agency, cast(sum(publication_count) as bigint) as publications,
              cast(sum(award_amount) as bigint) as award_amount,
              sum(publication_count) / nullif(sum(award_amount), 0) as publications_per_dollar
       from grants group by funding_agency""",
)
def publications_per_dollar_by_agency(t: Tables):
    return reports.publications_per_dollar_by_agency(t.grants)


@query(
    "agency_department_long",
    """select department, funding_agency, cast(sum(award_amount) as bigint) as award_amount
       from staged_grants_by_department group by 1, 2""",
)
def agency_department_long(t: Tables):
    return reports.agency_department(t.grant_sums)


@query(
    "agency_department_pivot",
    "select department, "
    + ", ".join(
        f"""cast(sum(award_amount) filter (where funding_agency = '{a}') as bigint) as "{a}" """ for a in AGENCIES
    )
    + """, cast(sum(award_amount) filter (where funding_agency not in ("""
    + ", ".join(f"'{a}'" for a in AGENCIES)
    + """) or funding_agency is null) as bigint) as other from staged_grants_by_department group by department""",
)
def agency_department_pivot(t: Tables):
    return reports.agency_department_pivot(t.grant_sums, AGENCIES)


@query(
    "top_departments",
    """select department, cast(sum(publication_count) as bigint) as publications,
              cast(sum(award_amount) as bigint) as award_amount
       from staged_grants_by_department group by department order by publications desc, department limit 5""",
)
def top_departments(t: Tables):
    return reports.top_departments(t.grant_sums)


@query(
    "award_outliers",
    """select grant_id, funding_agency, award_amount, round((award_amount - mean) / deviation, 6) as z_score
       from grants join (select funding_agency, avg(award_amount) as mean, stddev_samp(award_amount) as deviation
                         from grants group by funding_agency) s using (funding_agency)
       where deviation > 0 and abs((award_amount - mean) / deviation) > 3""",
)
def award_outliers(t: Tables):
    return reports.award_outliers(t.grants)


@query(
    "profile_students",
    """select count(*) as row_count, round(avg(gpa), 6) as mean_gpa,
              count(*) filter (where enrollment_status = 'Graduated') as graduated from students""",
)
def profile_students(t: Tables):
    return reports.profile(t.students, "students")


@query(
    "profile_faculty",
    """select count(*) as row_count, round(avg(salary), 6) as mean_salary,
              count(*) filter (where tenure_status = 'Tenured') as tenured from faculty""",
)
def profile_faculty(t: Tables):
    return reports.profile(t.faculty, "faculty")


@query(
    "profile_grants",
    """select count(*) as row_count, round(avg(award_amount), 6) as mean_award,
              cast(sum(award_amount) as bigint) as total_funding from grants""",
)
def profile_grants(t: Tables):
    return reports.profile(t.grants, "grants")


@query(
    "profile_courses",
    """select count(*) as row_count, round(avg(enrollment), 6) as mean_enrollment,
              round(avg(avg_rating), 6) as mean_rating from courses""",
)
def profile_courses(t: Tables):
    return reports.profile(t.courses, "courses")


@query("profile_enrollments", "select count(*) as row_count from enrollments")
def profile_enrollments(t: Tables):
    return reports.profile(t.enrollments, "enrollments")
