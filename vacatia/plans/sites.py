"""Postings of eight sites, built from parts in each site's own shape, as flat rows; and round trips through files."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.plans.registry import Queries, table
from vacatia.sources import envelopes, flatten, sinks
from vacatia.streaming.state import work_dir

QUERIES = Queries()
Q = QUERIES.add

SITES = ("careerviet", "glints", "itviec", "jobsgo", "topcv", "topdev", "vieclam24h", "vietnamworks")


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _payloads() -> list[Column]:
    """JSON texts in the order of SITES."""
    title, brand, kind, n = F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")
    pay, years = _say(n, " - ", (F.col("p_size") + 9).cast("string"), " triệu"), _say(n, " năm")
    of = lambda **fields: F.to_json(F.struct(*[v.alias(k.replace("_0_", "-").replace("_1_", " ")) for k, v in fields.items()]))
    months = F.struct(F.struct((F.col("p_size") * 12 + 6).alias("monthsOfExperience")).alias("experienceRequirements"))
    return [
        of(title=title, job_0_company_0_name=brand, map=F.lit("Hà Nội"), detail_0_box=F.array(F.lit("Ngày cập nhật 28/10/2026"), _say("Lương Lương: ", pay), _say("Kinh nghiệm Trên ", years)), skills=brand),
        of(job_0_title=title, company_0_name=brand, salary=pay, requirements=_say("Đại học CNTT\n", years, " kinh nghiệm"), skills=_say(brand, ", Kỹ năng")),
        of(title=title, company_name=brand, salary_display_text=pay, sections=F.create_map(F.lit("Mô tả"), F.array(kind, F.lit("b"))), job_posting_jsonld=months, skills=F.array(brand)),
        of(title=title, company=brand, salary_raw=pay, experience=years, description_bullets=F.array(kind, F.lit("y")), occupations=F.array(F.lit("IT"), F.lit("QA")), skills=brand),
        of(title=title, company=brand, salary_raw=pay, experience=years, description_bullets=F.array(kind), general_info=F.create_map(F.lit("Học vấn"), F.lit("Cử nhân")), overview_tags=F.create_map(F.lit("Chuyên môn"), F.array(brand))),
        of(title=title, company=F.struct(brand.alias("name")), salary_raw=pay, content=_say("<p>", kind, "</p>b"), job_posting_jsonld=months, skills_arr=F.array(brand)),
        of(title=title, company=F.struct(brand.alias("name")), salary=pay, experience_summary=years, description=F.array(_say("- ", kind), F.lit("b"), F.lit("- c")), keywords=F.array(brand)),
        of(jobTitle=title, companyName=brand, salaryMin=F.lit(0), prettySalary=pay, yearsOfExperience=F.col("p_size"), highestDegreeId=F.lit(4), skills=F.array(F.struct(brand.alias("skillName"))), description_list=F.array(kind, F.lit("z"))),
    ]


_R, _N = "p_partkey % 8", "p_size::varchar"


@Q(f"""select case {_R} {" ".join(f"when {i} then '{s}'" for i, s in enumerate(SITES))} end || '_' || p_partkey as job_id_global, p_name as title, p_brand as company, p_brand as skills, {_N} || ' - ' || (p_size + 9) || ' triệu' as salary,
    case {_R} when 0 then 'Trên ' || {_N} || ' năm' when 1 then {_N} || ' năm kinh nghiệm' when 2 then {_N} || '.5 năm (' || (p_size * 12 + 6) || ' tháng)' when 5 then (p_size * 12 + 6) || ' months' else {_N} || ' năm' end as experience,
    case {_R} when 0 then '' when 1 then '' when 2 then p_type || chr(10) || 'b' when 3 then p_type || chr(10) || 'y' when 4 then p_type when 5 then p_type || chr(10) || 'b' when 6 then '- ' || p_type || ' b' || chr(10) || '- c' else p_type || chr(10) || 'z' end as description,
    case {_R} when 1 then 'Đại học CNTT' when 4 then 'Cử nhân' when 7 then 'Cử nhân / Đại học' else '' end as education, case when {_R} = 3 then 'IT, QA' else '' end as category, case when {_R} = 0 then '28/10/2026' else '' end as posted from part""")
def site_rows(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("p_partkey") % 8
    pick = lambda values: reduce(lambda acc, v: acc.when(r == v[0], v[1]), list(enumerate(values))[1:], F.when(r == 0, values[0]))
    meta = F.to_json(F.struct(pick([F.lit(s) for s in SITES]).alias("source"), F.col("p_partkey").cast("string").alias("job_id"), F.lit("https://example.com").alias("source_url"), F.lit("2026-11-01T06:00:00Z").alias("scraped_at")))
    made = table(spark, d, "part").select(F.parse_json(_say('{"metadata":', meta, ',"raw_payload":', pick(_payloads()), "}")).alias("envelope"))
    text = lambda c: F.coalesce(c, F.lit(""))
    flat = flatten.flatten(made)
    return flat.select(
        "job_id_global", text("job_title").alias("title"), text("company_name").alias("company"), F.array_join("skills_list", ",").alias("skills"), text("raw_salary_text").alias("salary"), text("raw_experience_text").alias("experience"),
        text("raw_description_text").alias("description"), text("raw_education_text").alias("education"), text("raw_category_text").alias("category"), text("raw_posted_date").alias("posted"),
    )


def _path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/vacatia/{name}-{uuid.uuid4().hex}"


@Q("select p_partkey, p_name, p_brand || ',' || p_type as tags from part")
def lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as a JSON object a line, and read again."""
    path = _path(spark, "lines")
    sinks.lines(table(spark, d, "part").select("p_partkey", "p_name", F.array("p_brand", "p_type").alias("tags")), path)
    return spark.read.schema("p_partkey long, p_name string, tags array<string>").json(path).select("p_partkey", "p_name", F.array_join("tags", ",").alias("tags"))


@Q("""select p_partkey::varchar as p_partkey, p_name, '["' || p_brand || '","a \\"b\\", c"]' as tags from part""")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as CSV with lists as JSON, and read again with its header."""
    path = _path(spark, "csv")
    sinks.csv(table(spark, d, "part").select("p_partkey", "p_name", F.array(F.col("p_brand"), F.lit('a "b", c')).alias("tags")), path)
    return spark.read.option("header", "true").option("escape", '"').csv(path).select("p_partkey", "p_name", "tags")


@Q("select source as source_platform, count(*) as n, sum(n_chars)::bigint as chars from documents group by source")
def sources_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A folder a source, of which only the columns asked for are read."""
    path = _path(spark, "sources")
    sinks.by_source(table(spark, d, "documents").select(F.col("source").alias("source_platform"), "doc_id", "n_chars"), path)
    return envelopes.read_table(spark, path, ["source_platform", "n_chars"]).groupBy("source_platform").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@Q("""select case when event_id % 9 = 0 then 'broken' else 'ok' end as kind, count(*) as n, count(distinct case when event_id % 9 = 0 then ('{"broken ' || repeat('x', 90))[1:80] end) as starts from events group by 1""")
def bad_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of which some are not JSON: counted, with the start of what is broken."""
    path = _path(spark, "bad-lines")
    line = F.when(F.col("event_id") % 9 == 0, _say('{"broken ', "x" * 90)).otherwise(F.to_json(F.struct("event_id", "event_type")))
    table(spark, d, "events").select(line.alias("value")).write.text(path)
    read = envelopes.read_lines(spark, path)
    return read.groupBy(F.when(F.col("broken").isNull(), "ok").otherwise("broken").alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("broken").alias("starts"))
