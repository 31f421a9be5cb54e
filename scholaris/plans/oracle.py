"""The same tables as SQL common table expressions, for checking against another engine."""

import re

TABLES = {
    "students": """
select 'STU_' || lpad(cast(c_custkey as string), 8, '0') as student_id,
       cast(case when c_custkey % 131 = 6 then 1990 else 2016 + c_custkey % 11 end as bigint) as cohort_year,
       c_mktsegment as major,
       case when c_custkey % 97 = 5 then 4.5e0
            when c_custkey % 89 = 7 then cast(null as double)
            else round((c_acctbal + 1000e0) / 2750e0, 2) end as gpa,
       case when c_custkey % 10 = 3 then 'Withdrawn'
            when c_custkey % 11 <= 6 then 'Graduated'
            else 'Active' end as enrollment_status,
       make_date(cast(2016 + c_custkey % 11 as int), 8, cast(1 + c_custkey % 31 as int)) as date_enrolled,
       case when c_custkey % 10 = 3 or c_custkey % 11 > 6 then cast(null as date)
            when c_custkey % 53 = 0 then make_date(cast(2015 + c_custkey % 11 as int), 5, 1)
            when c_custkey % 4 = 0 then make_date(cast(2021 + c_custkey % 11 as int), 5, cast(1 + c_custkey % 31 as int))
            else make_date(cast(2020 + c_custkey % 11 as int), 5, cast(1 + c_custkey % 31 as int)) end as date_graduated,
       cast(case when c_custkey % 10 = 3 then c_custkey % 60
                 when c_custkey % 11 <= 6 then case when c_custkey % 41 = 0 then 100 else 120 + c_custkey % 15 end
                 else case when c_custkey % 37 = 0 then 0 else 30 + c_custkey % 60 end end as bigint) as credits_completed,
       case c_custkey % 6 when 0 then 'Asian' when 1 then 'White' when 2 then 'Hispanic'
                          when 3 then 'Black' when 4 then 'Non-Resident Alien' else 'Two or More Races' end as ethnicity,
       c_custkey % 4 = 0 as first_generation
from customer
""",
    "faculty": """
select 'FAC_' || lpad(cast(s_suppkey as string), 8, '0') as faculty_id,
       case s_suppkey % 5 when 0 then 'Assistant Professor' when 1 then 'Associate Professor'
                          when 2 then 'Full Professor' when 3 then 'Lecturer' else 'Adjunct' end as rank,
       case when s_suppkey % 61 = 8 then make_date(2999, 1, 1)
            else make_date(cast(2000 + s_suppkey % 25 as int), cast(1 + s_suppkey % 12 as int), cast(1 + s_suppkey % 28 as int)) end as hire_date,
       n_name as department,
       cast(case when s_suppkey % 43 = 7 then 0 else floor(65000e0 + s_acctbal * 20e0) end as bigint) as salary,
       case when s_suppkey % 20 = 0 then 'On Leave' else 'Active' end as employment_status,
       case s_suppkey % 5 when 0 then 'Tenure-Track' when 1 then 'Tenured'
                          when 2 then 'Tenured' else 'Non-Tenure-Track' end as tenure_status,
       case s_suppkey % 3 when 0 then 'Biology' when 1 then 'Chemistry' else 'Physics' end as research_focus
from supplier join nation on s_nationkey = n_nationkey
""",
    "grants": """
select 'GNT_' || lpad(cast(o_orderkey as string), 10, '0') as grant_id,
       case when o_orderkey % 71 = 9 then 'FAC_99999999'
            else 'FAC_' || lpad(cast(o_custkey % (select count(*) from supplier) as string), 8, '0') end as pi_id,
       cast(case when o_orderkey % 59 = 3 then 0 when o_orderkey % 397 = 5 then floor(o_totalprice * 20e0) else floor(o_totalprice) end as bigint) as award_amount,
       o_orderpriority as funding_agency,
       cast(o_orderdate as date) as start_date,
       cast(o_orderdate as date) + cast(case when o_orderkey % 83 = 4 then -30 else 365 * (1 + o_orderkey % 5) end as int) as end_date,
       'College' as department,
       case when o_orderstatus = 'O' then 'Active' when o_orderkey % 20 = 0 then 'Cancelled' else 'Completed' end as status,
       cast(floor(o_totalprice / 100000e0 * (1 + o_orderkey % 5)) as bigint) as publication_count
from orders
""",
    "courses": """
select 'CRS_' || lpad(cast(p_partkey as string), 8, '0') as course_id,
       p_brand as course_code,
       p_name as course_title,
       cast(case when p_partkey % 101 = 3 then 6 else 1 + p_partkey % 4 end as bigint) as credits,
       case p_partkey % 3 when 0 then 'Fall' when 1 then 'Spring' else 'Summer' end as semester,
       cast(2016 + p_partkey % 11 as bigint) as year,
       'FAC_' || lpad(cast(p_partkey % (select count(*) from supplier) as string), 8, '0') as instructor_id,
       cast(15 + p_partkey % 235 as bigint) as enrollment,
       case when p_partkey % 113 = 2 then 1.2e0 else round(0.75e0 + (p_partkey % 24) / 100e0, 3) end as pass_rate,
       case when p_partkey % 127 = 4 then 5.5e0 else round(1e0 + (p_size % 41) / 10e0, 1) end as avg_rating
from part
""",
    "enrollments": """
select enrollment_id, student_id, course_id, semester, year, grade, grade_point,
       cast(case when l_orderkey % 401 = 12 then -1 when grade = 'F' and l_linenumber <> 7 then 0 else 1 + l_partkey % 4 end as bigint) as credits_earned
from (
  select *, case when grade_point >= 3.7e0 then 'A' when grade_point >= 3.3e0 then 'A-'
                 when grade_point >= 3.0e0 then 'B+' when grade_point >= 2.7e0 then 'B'
                 when grade_point >= 2.3e0 then 'B-' when grade_point >= 2.0e0 then 'C'
                 when grade_point >= 1.0e0 then 'D' else 'F' end as grade
  from (
    select 'ENR_' || lpad(cast(l_orderkey * 10 + l_linenumber as string), 10, '0') as enrollment_id,
           case when l_orderkey % 67 = 1 then 'STU_99999999'
                when l_orderkey % 211 = 2 then cast(null as string)
                else 'STU_' || lpad(cast(o_custkey as string), 8, '0') end as student_id,
           'CRS_' || lpad(cast(l_partkey as string), 8, '0') as course_id,
           case when month(l_shipdate) >= 8 then 'Fall' when month(l_shipdate) <= 5 then 'Spring' else 'Summer' end as semester,
           cast(year(l_shipdate) + 21 as bigint) as year,
           case when l_orderkey % 307 = 11 then 4.8e0 else round(l_quantity * 0.08e0, 2) end as grade_point,
           l_orderkey, l_partkey, l_linenumber
    from lineitem join orders on l_orderkey = o_orderkey) a) b
""",
    "dim_student": """
select row_number() over (order by student_id nulls first, major nulls first, gpa nulls first) as student_key,
       student_id, major, gpa, true as dw_is_current
from students
""",
    "dim_faculty": """
select row_number() over (order by faculty_id nulls first, rank nulls first, department nulls first) as faculty_key,
       faculty_id, rank, department, true as dw_is_current
from faculty
""",
    "fact_enrollment": """
select row_number() over (order by enrollment_id nulls first, student_key nulls first, course_id nulls first,
                                   grade nulls first, grade_point nulls first, academic_year nulls first) as enrollment_key,
       student_key, course_id, grade, grade_point, academic_year
from (select e.enrollment_id, s.student_key, e.course_id, e.grade, e.grade_point, e.year as academic_year
      from enrollments e join dim_student s on e.student_id = s.student_id) j
""",
    "fact_research_grant": """
select row_number() over (order by grant_id nulls first, pi_key nulls first, award_amount nulls first,
                                   current_status nulls first, publication_count nulls first) as grant_key,
       grant_id, pi_key, award_amount, current_status, publication_count
from (select g.grant_id, f.faculty_key as pi_key, g.award_amount, g.status as current_status, g.publication_count
      from grants g join dim_faculty f on g.pi_id = f.faculty_id) j
""",
    "enrollment_detail": """
select s.student_id, s.major, e.grade, e.grade_point, e.academic_year
from fact_enrollment e join dim_student s on e.student_key = s.student_key
""",
    "grants_by_department": """
select f.department, g.* from fact_research_grant g join dim_faculty f on g.pi_key = f.faculty_key
""",
    "staged_grants_by_department": """
select f.department, g.grant_id, g.pi_id, g.award_amount, g.funding_agency, g.start_date, g.publication_count
from grants g join faculty f on g.pi_id = f.faculty_id
""",
    "term_retention": """
select major, term, count(*) as students, cast(count(*) filter (where next_term = term + 1) as bigint) as retained,
       round(count(*) filter (where next_term = term + 1) / count(*)::double, 6) as retention_rate,
       term = (select max(term) from student_terms) as final_term
from (select *, lead(term) over (partition by student_id order by term) as next_term from student_terms) t
join students using (student_id)
group by major, term
""",
    "student_terms": """
select distinct student_id, year * 2 + case when semester = 'Fall' then 1 else 0 end as term
from enrollments where student_id is not null and semester <> 'Summer'
""",
    "faculty_scores": """
select f.faculty_id, f.rank, f.department, f.salary, g.publications, g.award_amount,
       g.publications * 100000e0 / nullif(g.award_amount, 0) as score
from faculty f left join (select pi_id, cast(sum(publication_count) as bigint) as publications,
                                 cast(sum(award_amount) as bigint) as award_amount
                          from grants group by pi_id) g on f.faculty_id = g.pi_id
""",
}


def with_tables(body: str) -> str:
    """The query preceded by the tables it uses, directly or through others."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name, definition in TABLES.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(definition)
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body.strip()
    return "with " + ",\n".join(f"{n} as ({TABLES[n].strip()})" for n in used) + "\n" + body.strip()
