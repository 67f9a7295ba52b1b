"""The posting pipeline over envelopes that are built from the parts, customers and orders of a table folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.plans import steps
from vacatia.plans.registry import Queries, table

QUERIES = Queries()
Q = QUERIES.add

_BODY = "Phát triển hệ thống backend bằng Python và Django cho khách hàng. "


def envelopes(spark: SparkSession, d: str) -> DataFrame:
    """(file, kind, envelope): a posting for each part, in the generic, jobsgo and topcv shapes; some twice."""
    p = table(spark, d, "part")
    n, k = F.col("p_size").cast("string"), F.col("p_partkey")
    source = F.when(k % 3 == 0, "jobsgo").when(k % 3 == 1, "topcv").otherwise("src_a")
    say = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    title = F.when(k % 5 == 0, say("Kế toán ", F.col("p_brand"))).otherwise(say("Senior Backend Developer ", F.col("p_brand")))
    meta = F.struct(source.alias("source"), k.cast("string").alias("job_id"), say("https://example.com/", k.cast("string")).alias("source_url"), F.lit("2026-11-01T06:00:00Z").alias("scraped_at"), F.lit(1).alias("version"))
    lines = F.array(say(_BODY * 4), say("Yêu cầu: ", n, " năm kinh nghiệm"))
    payload = F.struct(
        title.alias("title"), say("Cty ", F.col("p_type")).alias("company"), say(n, " - ", (F.col("p_size") + 9).cast("string"), " triệu").alias("salary_raw"), say(n, " năm").alias("experience"),
        F.lit("Quận 1, TP. Hồ Chí Minh").alias("location"), lines.alias("description_bullets"), F.array_join(lines, "\n").alias("description"), F.array(F.lit("Python"), F.lit("Docker")).alias("skills"),
    )
    made = p.select(say("raw/", source, "/2026-11-01/", k.cast("string"), "_v1.json").alias("file"), F.lit("snapshot").alias("kind"), F.to_json(F.struct(meta.alias("metadata"), payload.alias("raw_payload"))).alias("j"))
    again = made.filter(F.col("file").rlike("7_v1")).select("file", F.lit("batch").alias("kind"), "j")
    return made.union(again).select("file", "kind", F.parse_json("j").alias("envelope"))


@Q("select count(*)::bigint as rows_in from (select p_partkey from part union all select p_partkey from part where p_partkey % 10 = 7)")
def posting_envelopes(spark: SparkSession, d: str) -> DataFrame:
    return envelopes(spark, d).agg(F.count("*").alias("rows_in"))


@Q("""with p as (select p_partkey as k, p_type, p_brand, case p_partkey % 3 when 0 then 'jobsgo' when 1 then 'topcv' else 'src_a' end as s, p_partkey % 5 = 0 as acc from part),
    key as (select *, case when acc then 'a' else 'b' end || p_brand || p_type as dk from p),
    c6 as (select *, row_number() over (partition by s, dk order by s || '_' || k) as n6 from key), c7 as (select *, count(distinct s) over (partition by dk) as ns, row_number() over (partition by dk order by s, k::varchar) as n7 from c6 where n6 = 1)
    select 'C2' as rule, count(*) as n from p where k % 10 = 7 union all select 'C6', count(*) from c6 where n6 > 1 union all select 'C7', count(*) from c7 where ns > 1 and n7 > 1""")
def posting_clean(spark: SparkSession, d: str) -> DataFrame:
    """What the clean step drops, by rule."""
    _, dropped = steps.clean(envelopes(spark, d))
    return dropped.groupBy("rule").agg(F.count("*").alias("n"))


def _normalised(spark: SparkSession, d: str) -> DataFrame:
    kept, _ = steps.clean(envelopes(spark, d))
    return steps.normalise(steps.transform(steps.integrate(kept)))


@Q()
def posting_typed(spark: SparkSession, d: str) -> DataFrame:
    n = _normalised(spark, d)
    return n.select("job_id_global", "it_status", "dedup_key", "salary_min_vnd", "salary_max_vnd", "salary_source", "exp_min_years", "seniority", "job_family", "tinh_chinh", "language", F.array_join("skills_std", ",").alias("skills"), F.array_join("also_on", ",").alias("also_on"))


@Q()
def posting_features(spark: SparkSession, d: str) -> DataFrame:
    return steps.encode_features(_normalised(spark, d))
