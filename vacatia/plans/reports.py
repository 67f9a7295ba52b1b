"""Queries of reports, ledgers and plans of transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.functions import reports as R
from vacatia.functions import urls
from vacatia.plans.registry import Queries, table

QUERIES = Queries()
Q = QUERIES.add


@Q("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '_' || lower(o_orderpriority) || '_' || lpad((o_orderkey % 1000)::varchar, 3, '0') as batch_id from orders")
def batch_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", R.batch_id(F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderkey") % 1000).alias("batch_id"))


_NAMES = ", ".join(f"'{n}'" for n in R.TRACKING_NAMES)
_PAIRS = rf"array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(url), '\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+') and lower(split_part(p, '=', 1)) not in ({_NAMES}))), '&')"
_PATH = r"regexp_replace(regexp_extract(trim(url), '^[^:]+://[^/?#]*([^?#]*)', 1), '/+$', '')"


@Q(rf"select page_id, regexp_extract(trim(url), '^([^:]+://[^/?#]*)', 1) || case when {_PATH} = '' then '/' else {_PATH} end || case when {_PAIRS} <> '' then '?' || {_PAIRS} else '' end as url from pages")
def tracked_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", R.tracked_url(F.col("url")).alias("url"))


@Q("""select p_partkey, case p_partkey % 5 when 0 then p_size::double when 1 then p_size + 0.5 when 2 then p_size::double when 3 then 0.0 end as years from part""")
def least_experience(spark: SparkSession, d: str) -> DataFrame:
    r, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = F.when(r == 0, F.concat(n, F.lit(" đến "), (F.col("p_size") + 3).cast("string"), F.lit(" năm"))).when(r == 1, F.concat(n, F.lit(",5+ Years"))).when(r == 2, F.concat(F.lit("Từ "), n, F.lit(" yrs")))
    text = text.when(r == 3, F.concat(F.lit("Không yêu cầu, "), n, F.lit(" năm là lợi thế"))).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", R.least_experience(text).alias("years"))


@Q(f"select source, count(*) as n, count(*) filter (where lower(trim(v)) in ({', '.join(repr(v) for v in R.REPORT_EMPTY)}) or v is null) as empty from (select source, case doc_id % 6 when 0 then ' Updating ' when 1 then '--' when 2 then null when 3 then '0' when 4 then lang else source end as v from documents) group by source")
def report_empty(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("doc_id") % 6
    v = F.when(r == 0, " Updating ").when(r == 1, "--").when(r == 3, "0").when(r == 4, F.col("lang")).when(r == 5, F.col("source"))
    return table(spark, d, "documents").select("source", v.alias("v")).groupBy("source").agg(F.count("*").alias("n"), F.count_if(R.is_empty(F.col("v"))).alias("empty"))


@Q("""select c_custkey, case c_custkey % 5 when 0 then 'Hồ Chí Minh' when 1 then 'Hà Nội' when 2 then 'Remote' when 3 then 'Không xác định' else c_name end as city from customer""")
def old_cities(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("c_custkey") % 5
    text = F.when(r == 0, F.concat("c_name", F.lit(", Bình Thạnh, TP.HCM"))).when(r == 1, F.concat(F.lit("Ba Đình, "), "c_name")).when(r == 2, "Toàn quốc (online)").when(r == 4, F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return table(spark, d, "customer").select("c_custkey", R.old_city(text).alias("city"))


@Q("select event_id, sha256('{\"k\":\"' || (props->>'$.k') || '\"}') as digest from events")
def tracked_field_hash(spark: SparkSession, d: str) -> DataFrame:
    """The hash of the fields whose change counts; others come and go without one."""
    fields = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("views"), F.col("event_id").cast("string")))
    return table(spark, d, "events").select("event_id", urls.canonical_json_hash(R.only(fields, ("k", "title"))).alias("digest"))


@Q("""select r.page_id, r.size, case when l.page_id is null then 'new' else 'changed' end as reason from (select page_id, strlen(html) as size from pages) r
    left join (select page_id, case when page_id % 7 = 0 then 0 else strlen(html) end as size from pages where page_id % 3 <> 0) l using (page_id) where l.page_id is null or l.size <> r.size""")
def download_plan(spark: SparkSession, d: str) -> DataFrame:
    """Objects to fetch: those that are not at hand with an equal size."""
    remote = table(spark, d, "pages").select("page_id", F.octet_length("html").cast("long").alias("size"))
    local = remote.filter("page_id % 3 <> 0").select("page_id", F.when(F.col("page_id") % 7 == 0, 0).otherwise(F.col("size")).alias("here"))
    j = remote.join(local, "page_id", "left").filter("here is null or here <> size")
    return j.select("page_id", "size", F.when(F.col("here").isNull(), "new").otherwise("changed").alias("reason"))


@Q("select doc_id, source from documents where source in (select source from documents group by source order by source limit 3)")
def chosen_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    chosen = [r["source"] for r in docs.select("source").distinct().orderBy("source").limit(3).collect()]
    return docs.filter(F.col("source").isin(chosen))


@Q("select o_orderkey, row_number() over (order by md5('7:' || o_orderkey), o_orderkey)::int as place from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus = 'O' order by place limit 40")
def seeded_selection(spark: SparkSession, d: str) -> DataFrame:
    """Pending rows of some groups in an order that a seed fixes."""
    from pyspark.sql import Window as W

    order = F.md5(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string")).cast("binary"))
    some = table(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "O")).select("o_orderkey")
    first = some.orderBy(order, "o_orderkey").limit(40)
    return first.withColumn("place", F.row_number().over(W.orderBy(order, "o_orderkey")))  # 40 rows


@Q("""select 'status' as encoder, count(*) filter (where o_orderstatus in ('F', 'O', 'P')) as n from orders union all select 'priority', count(*) filter (where o_orderpriority in ('1-URGENT', '2-HIGH')) from orders
    union all select 'price_missing', count(*) filter (where o_totalprice is null) from orders""")
def encoder_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each encoder gives a value, from one pass."""
    tests = {"status": F.col("o_orderstatus").isin("F", "O", "P"), "priority": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "price_missing": F.col("o_totalprice").isNull()}
    row = table(spark, d, "orders").agg(*[F.count_if(t).alias(k) for k, t in tests.items()])
    return row.unpivot([], list(tests), "encoder", "n")
