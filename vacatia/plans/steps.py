"""The posting pipeline: clean, integrate, transform, normalise, encode. A step's output is a table, the next one's only input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.functions import classify, dates, money, places, text
from vacatia.functions import terms as T
from vacatia.operators import dedup, encode, quality, stats
from vacatia.sources import flatten as fl
from vacatia.streaming.state import stage

# An id that a test posting has, and the columns whose filling makes a row better.
TEST_ID = r"^job-[a-z]+-\d+$"
BEST_BY = ("job_title", "company_name", "raw_location_text", "raw_posted_date", "raw_description_text", "skills_list")
SOURCES = tuple(sorted(fl.SITES))


def _day(c: Column) -> Column:
    return dates.parse_date(c)


def dedup_key() -> Column:
    """company|title|province|ISO week; NULL without title or company."""
    title = F.btrim(F.regexp_replace(F.lower(F.coalesce("job_title", F.lit(""))), r"(?U)\s+", " "), F.lit(" .,-:;!|"))
    company = text.company_block(F.col("company_name"))
    where = F.coalesce(F.get("working_locations", F.lit(0)), F.col("raw_location_text"))
    day = F.coalesce(_day(F.col("raw_posted_date")), _day(F.col("crawled_at")))
    return F.when((title != "") & (company != ""), F.concat_ws("|", company, title, F.coalesce(places.province(where), F.lit("")), F.coalesce(dates.iso_week(day), F.lit(""))))


def filled() -> Column:
    some = lambda c: F.size(c) > 0 if c == "skills_list" else F.trim(c) != ""
    return reduce(lambda a, b: a + b, [F.coalesce(some(c), F.lit(False)).cast("int") for c in BEST_BY])


def clean(envelopes: DataFrame, policy: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) of envelopes (file, kind, envelope). dropped has rule and the winner where there is one.

    C3 ids, C1 latest snapshot of a job, C2 batch rows of jobs with a snapshot, C4 relevance and policy (source, it_status),
    C5 short descriptions, C6 copies in a source, C7 copies across sources."""
    flat = stage(fl.flatten(envelopes), "flat")
    out: list[DataFrame] = []

    def drop(df: DataFrame, rule: str, test: Column, winner: Column | None = None) -> DataFrame:
        won = F.lit(None).cast("string") if winner is None else winner
        out.append(df.filter(test).select("job_id_global", "source_platform", F.lit(rule).alias("rule"), won.alias("winner")))
        return df.filter(~test)

    unusable = (F.col("source_job_id") == "") | F.col("source_job_id").rlike(TEST_ID) | (F.col("source_url") == "") | ~F.col("source_platform").rlike("^[a-z0-9_]+$")
    df = drop(flat, "C3", unusable)
    by_job = W.partitionBy("job_id_global")
    newest = by_job.orderBy(F.col("kind") != "snapshot", F.desc("crawled_at"), F.desc("version"), "file")
    df = df.withColumn("_n", F.row_number().over(newest)).withColumn("_first", F.first("kind").over(newest)).withColumn("_won", F.first("file").over(newest))
    df = drop(df, "C2", (F.col("kind") == "batch") & (F.col("_first") == "snapshot"))
    df = drop(df, "C1", F.col("_n") > 1, F.col("_won")).drop("_n", "_first", "_won")
    words = F.concat_ws(" ", F.coalesce("raw_description_text", F.lit("")), F.coalesce("raw_requirements_text", F.lit("")))
    first = classify.relevance(F.col("job_title"), F.col("skills_list"))
    df = df.withColumn("_jd", words).withColumn("_r", first)
    df = df.withColumn("it_rule_level", F.when(F.col("_r") == "unknown", 2).otherwise(1))
    df = df.withColumn("it_status", F.when(F.col("_r") == "unknown", classify.relevance_of_unknown(F.col("job_title"), F.col("skills_list"), F.col("_jd"))).otherwise(F.col("_r"))).withColumn("it_rule", F.col("_r"))
    df = stage(df, "relevance")
    if policy is not None:
        marked = df.join(F.broadcast(policy.select("source_platform", "it_status").distinct().withColumn("_drop", F.lit(True))), ["source_platform", "it_status"], "left")
        df = drop(marked, "C4c", F.coalesce("_drop", F.lit(False))).drop("_drop")
    df = drop(df, "C5", text.word_count(F.col("_jd")) < T.MIN_WORDS).withColumn("dedup_key", dedup_key()).withColumn("_filled", filled())
    own = W.partitionBy("source_platform", "dedup_key").orderBy(F.desc("crawled_at"), F.desc("_filled"), "job_id_global")
    keyed = F.col("dedup_key").isNotNull()
    df = df.withColumn("_n", F.when(keyed, F.row_number().over(own)).otherwise(1)).withColumn("_won", F.first("job_id_global").over(own))
    df = drop(df, "C6", F.col("_n") > 1, F.col("_won")).drop("_n", "_won")
    df = dedup.across_sources(df, "dedup_key", "source_platform", "source_job_id", [F.desc("_filled"), F.asc("source_platform"), F.asc("source_job_id")])
    df = drop(df, "C7", ~F.col("kept"))
    return stage(df.drop("kept", "_jd", "_r", "_filled"), "clean"), reduce(DataFrame.union, out)


def integrate(df: DataFrame) -> DataFrame:
    """The contract's 28 columns, empty values as NULL."""
    kinds = dict(df.dtypes)
    blank = lambda c: (F.size(c) == 0) if kinds[c].startswith("array") else (F.trim(c) == "" if kinds[c] == "string" else F.lit(False))
    columns = [F.when(~blank(c), F.col(c)).alias(c) for c in (*fl.KEYS, *fl.CLEAN, *fl.KEPT)]
    return quality.require(df.select(*columns), [*fl.KEYS, *fl.CLEAN, *fl.KEPT], ["raw_age_text", "raw_gender_text", "raw_work_mode"])


def transform(df: DataFrame) -> DataFrame:
    """Typed columns out of the texts; rows stay as they are."""
    raw = [c for c in df.columns if c.startswith("raw_")]
    df = df.select(*[F.when(~classify.is_null(F.col(c)), F.col(c)).alias(c) if c in raw else F.col(c) for c in df.columns])
    body = lambda c: F.array_join(text.stitch_bullets(F.split(text.strip_html(F.col(c)), "\n")), "\n")
    df = df.withColumn("description_clean", body("raw_description_text")).withColumn("requirements_clean", body("raw_requirements_text")).withColumn("job_title_clean", text.collapse(F.col("job_title")))
    df = stage(df.withColumn("_jd", F.concat_ws("\n", "description_clean", "requirements_clean")), "texts")
    df = df.withColumn("language", text.language_by_letters(F.col("_jd"), F.col("job_title"), F.col("company_name")))
    df = df.withColumn("_s", money.salary_cascade(F.col("raw_salary_text"), F.col("job_title_clean"), F.col("_jd"))).withColumn("_e", money.experience(F.col("raw_experience_text")))
    posted, deadline, crawled = (dates.parse_date(F.col(c)) for c in ("raw_posted_date", "raw_deadline", "crawled_at"))
    s, e = F.col("_s"), F.col("_e")
    df = df.select(
        "*", s["low"].alias("salary_min_vnd"), s["high"].alias("salary_max_vnd"), s["currency"].alias("salary_currency_raw"), s["period"].alias("salary_period_raw"), s["negotiable"].alias("is_negotiable"),
        s["source"].alias("salary_source"), s["suspect"].alias("salary_suspect"), posted.alias("posted_date"), deadline.alias("deadline_date"), e["low"].alias("exp_min_years"), e["high"].alias("exp_max_years"),
        money.headcount(F.col("raw_headcount")).alias("headcount"), classify.all_skills(F.coalesce("skills_list", F.array().cast("array<string>")), F.col("_jd"), F.col("company_name")).alias("skills_clean"),
        classify.benefits(F.coalesce("benefits_list", F.array().cast("array<string>")), F.col("_jd")).alias("benefits_std"), places.locations(F.col("working_locations"), F.col("raw_location_text"), F.col("company_address")).alias("locations"),
        F.array_compact(F.array(F.when(s["suspect"], "salary_suspect"), F.when(deadline < crawled, "deadline_before_crawl"))).alias("flags"),
    )
    return stage(df.drop("_jd", "_s", "_e"), "transformation")


def normalise(df: DataFrame) -> DataFrame:
    """Standard places, skills, levels and families, then the salary stage over all rows."""
    located = F.transform("locations", lambda x: x.withField("tinh_key", places.province(F.coalesce(x["province"], x["raw"]))).withField("remote", places.is_remote(x["raw"])).withField("ngoai_vn", places.is_abroad(x["raw"])))
    df = df.withColumn("locations", located).withColumn("tinh_chinh", F.get(F.filter(F.transform("locations", lambda x: x["province"]), lambda p: p.isNotNull()), F.lit(0)))
    df = df.withColumn("skills_std", classify.canonical(F.col("skills_clean"))).withColumn("_l", classify.level(F.col("raw_seniority_text"), F.col("job_title_clean"), F.col("exp_min_years"))).withColumn("_f", classify.family(F.col("job_title_clean"), F.col("skills_std")))
    df = df.select("*", F.col("_l.level").alias("seniority"), F.col("_l.source").alias("seniority_source"), F.col("_f.family").alias("job_family"), F.col("_f.source").alias("job_family_source"), text.company_name(F.col("company_name")).alias("company_norm"))
    df = df.withColumn("seniority_can_kiem", classify.level_conflict(F.col("seniority"), F.col("exp_min_years"), F.col("exp_max_years")))
    df = df.withColumn("job_family_can_kiem", (F.col("job_family") != T.OTHER_FAMILY) & (F.size("skills_std") == 0)).drop("_l", "_f", "salary_suspect")
    out = stats.normalise_salaries(stage(df, "rows"), "salary_min_vnd", "salary_max_vnd", "description_clean")
    return stage(out.withColumnRenamed("log_salary_min_vnd", "log_salary_min").withColumnRenamed("log_salary_max_vnd", "log_salary_max"), "normalization")


def encode_features(df: DataFrame) -> DataFrame:
    """The numeric feature table: vocabularies from all rows first, then one pass."""
    keys = F.transform(F.coalesce("locations", F.array().cast(dict(df.dtypes)["locations"])), lambda x: x["tinh_key"])
    counts = df.select(F.explode(keys).alias("k")).filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    top = [r["k"] for r in counts.orderBy(F.desc("n"), "k").limit(T.TOP_PROVINCES).collect()]
    slugs = [s for s, _ in encode.vocabulary(df, F.col("skills_std"), T.SKILL_MIN_COUNT, T.SKILL_MOST)]
    byte = lambda c, name: F.coalesce(c, F.lit(False)).cast("byte").alias(name)
    days = dates.days_between(F.col("deadline_date"), F.col("posted_date"))
    known = F.array(*[F.lit(k) for k in top]) if top else F.array().cast("array<string>")
    out = df.select(
        "job_id_global", classify.ordinal(F.col("seniority")).alias("seniority_ord"), *encode.one_hot(F.col("job_family"), "job_family", [*[f for f, *_ in T.FAMILIES], T.OTHER_FAMILY]),
        *encode.one_hot(F.col("source_platform"), "source_platform", list(SOURCES)), *encode.one_hot(classify.employment(F.col("raw_employment_type")), "employment_type", ["full_time", "part_time", "intern", "other", "missing"]),
        *[byte(F.array_contains(keys, k), f"tinh__{k}") for k in top], byte(F.exists(keys, lambda k: k.isNotNull() & ~F.array_contains(known, k)), "tinh__other"),
        byte(F.exists("locations", lambda x: x["remote"]), "is_remote"), byte(F.exists("locations", lambda x: x["ngoai_vn"]), "is_foreign"), *encode.multi_hot(F.col("skills_std"), "skill", slugs),
        *encode.numeric(["log_salary_min", "log_salary_max", "exp_min_years", "exp_max_years", "headcount"]), byte(F.col("is_negotiable"), "is_negotiable"), byte(F.col("is_outlier_salary"), "is_outlier_salary"),
        F.coalesce(F.month("posted_date"), F.lit(0)).alias("posted_month"), F.coalesce(days, F.lit(0)).alias("days_to_deadline"), days.isNull().cast("byte").alias("days_to_deadline__missing"),
        byte(F.col("it_rule_level") == 2, "it_rule_level__2"), byte(F.col("seniority_can_kiem"), "seniority_can_kiem"), byte(F.col("job_family_can_kiem"), "job_family_can_kiem"),
    )
    return quality.require_numeric(out, "job_id_global")
