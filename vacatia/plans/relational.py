"""Latest and best rows, joins and merges, orders and limits, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.functions import arrays
from vacatia.operators import dedup, merge, quality
from vacatia.plans.registry import Queries, table

QUERIES = Queries()
Q = QUERIES.add


@Q("select user_id, ts, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id) = 1")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], [F.desc("ts"), F.asc("event_id")])


@Q("""select doc_id, source, lang, row_number() over w = 1 as kept, first_value(doc_id) over w as winner from documents
    window w as (partition by source, lang order by n_chars desc, doc_id)""")
def keep_best_in_group(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return dedup.ranked(docs, ["source", "lang"], [F.desc("n_chars"), F.asc("doc_id")], "doc_id").drop("n_chars")


_ACROSS = """with k as (select doc_id, source, n_chars, md5(lower(trim(text))) as k from documents),
    r as (select *, (select count(distinct source) from k k2 where k2.k = k.k) as s, row_number() over (partition by k order by n_chars desc, source, doc_id) as rk from k)"""


@Q(_ACROSS + """ select r.doc_id, r.source, (s = 1 or rk = 1) as kept,
    case when s > 1 and rk = 1 then (select string_agg(l.source || ':' || l.doc_id, ',' order by l.rk) from r l where l.k = r.k and l.rk > 1) else '' end as also_on from r""")
def cross_source_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _across(spark, d).select("doc_id", "source", "kept", F.array_join("also_on", ",").alias("also_on"))


def _across(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars", F.md5(F.lower(F.trim("text")).cast("binary")).alias("k"))
    return dedup.across_sources(docs, "k", "source", "doc_id", [F.desc("n_chars"), F.asc("source"), F.asc("doc_id")])


@Q(_ACROSS + """ select w.source as winner, l.source as loser, count(*) as n from r w join r l on w.k = l.k where w.rk = 1 and l.rk > 1 and w.s > 1 group by all""")
def source_pairs(spark: SparkSession, d: str) -> DataFrame:
    won = _across(spark, d).filter(F.size("also_on") > 0).select(F.col("source").alias("winner"), F.explode("also_on").alias("who"))
    return won.groupBy("winner", F.split_part("who", F.lit(":"), F.lit(1)).alias("loser")).agg(F.count("*").alias("n"))


def _funnel(i: int, keys: str) -> str:
    return f"""select {i}::bigint as level, coalesce(sum(n - 1), 0)::bigint as extra, count(*) filter (where s = 1) as same_source, count(*) filter (where s > 1) as cross_source
        from (select count(*) as n, count(distinct o_orderstatus) as s from orders group by {keys} having count(*) > 1)"""


@Q(" union all ".join((_funnel(1, "o_custkey"), _funnel(2, "o_custkey, o_orderpriority"), _funnel(3, "o_custkey, o_orderpriority, date_trunc('week', o_orderdate)"))))
def dedup_funnel(spark: SparkSession, d: str) -> DataFrame:
    key, priority, week = F.col("o_custkey"), F.col("o_orderpriority"), F.date_trunc("week", F.col("o_orderdate"))
    return dedup.funnel(table(spark, d, "orders"), [[key], [key, priority], [key, priority, week]], F.col("o_orderstatus"))


@Q("""select (count(*) - count(distinct (doc_id, text, lang, source)))::bigint as by_row, (count(*) - count(distinct doc_id))::bigint as by_id, (count(*) - count(distinct (lang, md5(text))))::bigint as by_content from documents""")
def duplicate_levels(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", F.xxhash64("doc_id", "text", "lang", "source").alias("row"), F.md5(F.col("text").cast("binary")).alias("content"))
    return docs.agg((F.count("*") - F.count_distinct("row")).alias("by_row"), (F.count("*") - F.count_distinct("doc_id")).alias("by_id"), (F.count("*") - F.count_distinct("lang", "content")).alias("by_content"))


@Q("select doc_id, source, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 0)")
def policy_anti(spark: SparkSession, d: str) -> DataFrame:
    drop = table(spark, d, "labels").filter("quality = 0").select("doc_id")
    return table(spark, d, "documents").select("doc_id", "source", "lang").join(drop, "doc_id", "left_anti")


@Q("select doc_id, source from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)")
def semi_batch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")


@Q("""select 'labels' as missing_in, doc_id from (select doc_id from documents except select doc_id from labels) union all
    select 'documents', doc_id from (select doc_id from labels except select doc_id from documents)""")
def both_ways_anti(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    one = lambda x, y, name: x.distinct().join(y, "doc_id", "left_anti").select(F.lit(name).alias("missing_in"), "doc_id")
    return one(a, b, "labels").union(one(b, a, "documents"))


@Q("""select l_orderkey, l_linenumber, o_orderstatus, date_diff('day', o_orderdate, l_shipdate)::int as lag_days from lineitem join orders on l_orderkey = o_orderkey
    where l_shipdate > o_orderdate + interval 90 day and o_orderstatus <> 'F'""")
def range_join_lag(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = lines.join(orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 90 days")))
    return j.select("l_orderkey", "l_linenumber", "o_orderstatus", F.datediff("l_shipdate", "o_orderdate").alias("lag_days"))


_SNAP = "select user_id, event_type, max(value) as v from events where event_id % 2 = {} group by all"


@Q(f"""with a as ({_SNAP.format(0)}), b as ({_SNAP.format(1)}) select coalesce(a.user_id, b.user_id) as user_id, coalesce(a.event_type, b.event_type) as event_type, a.v as old, b.v as new,
    case when a.user_id is null then 'added' when b.user_id is null then 'removed' else 'changed' end as change
    from a full join b on a.user_id = b.user_id and a.event_type = b.event_type where a.user_id is null or b.user_id is null or a.v is distinct from b.v""")
def version_diff(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    snap = lambda r: e.filter(F.col("event_id") % 2 == r).groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    return merge.version_diff(snap(0), snap(1), ["user_id", "event_type"], "v")


@Q(f"""with a as ({_SNAP.format(0)}), b as ({_SNAP.format(1)}) select coalesce(a.user_id, b.user_id) as user_id, coalesce(a.event_type, b.event_type) as event_type,
    case when b.user_id is null then 'move' when a.user_id is null then 'only_target' when a.v = b.v then 'duplicate' else 'conflict' end as plan
    from a full join b on a.user_id = b.user_id and a.event_type = b.event_type""")
def migrate_plan(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    snap = lambda r, v: e.filter(F.col("event_id") % 2 == r).groupBy("user_id", "event_type").agg(F.max("value").alias(v))
    j = snap(0, "a").join(snap(1, "b"), ["user_id", "event_type"], "full")
    return j.select("user_id", "event_type", F.when(F.col("b").isNull(), "move").when(F.col("a").isNull(), "only_target").when(F.col("a") == F.col("b"), "duplicate").otherwise("conflict").alias("plan"))


@Q("""with l as (select *, event_id % 2 as tier from events) select user_id, event_id, ts, event_type, value from l qualify row_number() over (partition by user_id order by ts desc, tier desc, event_id desc) = 1""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value").withColumn("_at", F.struct("ts"))
    base, updates = (dedup.latest(e.filter(F.col("event_id") % 2 == r), ["user_id"], [F.desc("ts"), F.desc("event_id")]) for r in (0, 1))
    return merge.upsert(base, updates, "user_id", "_at").select("user_id", "event_id", "ts", "event_type", "value")


@Q("""with led as (select distinct on (user_id) user_id, event_id, ts from events where event_id % 3 <> 0 order by user_id, ts desc, event_id desc),
    cand as (select * from events where event_id % 3 = 0 qualify row_number() over (partition by user_id order by (event_type = 'view') desc, ts desc, event_id desc) = 1)
    select cand.user_id, cand.event_id, case when led.user_id is null then 'create' when led.ts >= cand.ts then 'skip_newer' when cand.event_type = 'error' then 'skip_closed' else 'update' end as plan
    from cand left join led on cand.user_id = led.user_id""")
def reconcile_plan(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    ledger = dedup.latest(e.filter("event_id % 3 <> 0"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", F.col("ts").alias("known"))
    cand = dedup.latest(e.filter("event_id % 3 = 0"), ["user_id"], [F.desc(F.col("event_type") == "view"), F.desc("ts"), F.desc("event_id")])
    j = cand.join(ledger, "user_id", "left")
    plan = F.when(F.col("known").isNull(), "create").when(F.col("known") >= F.col("ts"), "skip_newer").when(F.col("event_type") == "error", "skip_closed").otherwise("update")
    return j.select("user_id", "event_id", plan.alias("plan"))


@Q("""with l as (select doc_id, md5(text) as h from documents where doc_id % 2 = 0), f as (select min(doc_id) as first_doc, h from l group by h)
    select d.doc_id, case when f.h is not null then 'hash' when k.doc_id is not null then 'id' else 'none' end as match_type, coalesce(f.first_doc, k.doc_id, -1) as matched
    from documents d left join f on md5(d.text) = f.h left join l k on k.doc_id = d.doc_id + 1""")
def two_tier_match(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    known = docs.filter("doc_id % 2 = 0")
    by_hash = known.groupBy("h").agg(F.min("doc_id").alias("first_doc"))
    by_id = known.select((F.col("doc_id") - 1).alias("doc_id"), F.col("doc_id").alias("same_id"))
    j = docs.join(by_hash, "h", "left").join(by_id, "doc_id", "left")
    return j.select("doc_id", F.when(F.col("first_doc").isNotNull(), "hash").when(F.col("same_id").isNotNull(), "id").otherwise("none").alias("match_type"), F.coalesce("first_doc", "same_id", F.lit(-1)).alias("matched"))


_DAYS = "select unnest(generate_series((select min(ts)::date from events), (select max(ts)::date from events), interval 1 day))::date as day"


@Q(f"""select day::varchar as day, event_type, count(e.event_id) as n from ({_DAYS}) x cross join (select distinct event_type as event_type from events) t
    left join (select event_id, ts::date as d2, event_type as t2 from events where event_id % 7 = 0) e on e.d2 = x.day and e.t2 = t.event_type group by all""")
def calendar_fill(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    counts = e.filter("event_id % 7 = 0").groupBy("day", "event_type").agg(F.count("*").alias("n"))
    filled = merge.calendar(merge.days_between(e, F.col("day")), e.select("event_type").distinct(), counts, ["day", "event_type"], "n")
    return filled.withColumn("day", F.col("day").cast("string"))


@Q(f"select day::varchar as day from ({_DAYS}) where day not in (select ts::date from events where event_id % 97 = 0)")
def gap_days(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))
    return merge.days_between(e, F.col("day")).join(e.filter("event_id % 97 = 0").select("day"), "day", "left_anti").select(F.col("day").cast("string").alias("day"))


@Q("""select day::varchar as day, n, sum(n) over (order by day)::bigint as total, round(row_number() over (order by day) * 1.0 / count(*) over () * sum(n) over (), 2) as plan
    from (select o_orderdate::date as day, count(*) as n from orders group by all)""")
def running_total(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    w, every = W.orderBy("day").rowsBetween(W.unboundedPreceding, 0), W.partitionBy()
    plan = F.row_number().over(W.orderBy("day")) * 1.0 / F.count("*").over(every) * F.sum("n").over(every)
    return days.select(F.col("day").cast("string").alias("day"), "n", F.sum("n").over(w).alias("total"), F.round(plan, 2).alias("plan"))


@Q("""with loc as (select page_id, strlen(html) as size from pages where page_id % 3 <> 0), rem as (select page_id, case when page_id % 5 = 0 then strlen(html) + 1 else strlen(html) end as size from pages)
    select rem.page_id, case when loc.page_id is null then 'chua_day' when loc.size = rem.size then 'khop' else 'lech' end as status from rem left join loc on rem.page_id = loc.page_id""")
def storage_status(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", F.octet_length("html").alias("size"))
    remote = pages.withColumn("size", F.when(F.col("page_id") % 5 == 0, F.col("size") + 1).otherwise(F.col("size")))
    local = pages.filter("page_id % 3 <> 0").withColumnRenamed("size", "local")
    status = F.when(F.col("local").isNull(), "chua_day").when(F.col("local") == F.col("size"), "khop").otherwise("lech")
    return remote.join(local, "page_id", "left").select("page_id", status.alias("status"))


@Q("""with k as (select source, doc_id, exists (select 1 from labels l where l.doc_id = d.doc_id) as here from documents d)
    select source, count(*) as total, count(*) filter (where here) as synced, round(100.0 * count(*) filter (where here) / count(*), 1) as pct,
        case when 100.0 * count(*) filter (where here) / count(*) >= 40 then 'SYNCED' else 'PARTIAL' end as status from k group by source""")
def sync_status(spark: SparkSession, d: str) -> DataFrame:
    here = table(spark, d, "labels").select("doc_id").distinct().withColumn("here", F.lit(1))
    pct = 100.0 * F.count("here") / F.count("*")
    g = table(spark, d, "documents").select("source", "doc_id").join(here, "doc_id", "left").groupBy("source")
    return g.agg(F.count("*").alias("total"), F.count("here").alias("synced"), F.round(pct, 1).alias("pct"), F.when(pct >= 40, "SYNCED").otherwise("PARTIAL").alias("status"))


@Q("""select min(page_id) as page_id, url from pages p where page_id % 4 = 0 and not exists (select 1 from pages a where a.page_id % 4 = 1 and a.page_id = p.page_id + 1 and a.page_id % 3 = 0)
    and not exists (select 1 from pages b where b.page_id % 4 = 2 and b.url = p.url) group by url""")
def batch_missing(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    files = pages.filter("page_id % 4 = 1 and page_id % 3 = 0").select((F.col("page_id") - 1).alias("page_id"))
    seen = pages.filter("page_id % 4 = 2").select("url")
    left = pages.filter("page_id % 4 = 0").join(files, "page_id", "left_anti").join(seen, "url", "left_anti")
    return left.groupBy("url").agg(F.min("page_id").alias("page_id")).select("page_id", "url")


@Q("""select user_id, string_agg(v, ',' order by first_at) as kinds from (select user_id, case event_type when 'click' then 'Tap' when 'view' then 'Look' when 'tap' then 'Tap' else event_type end as v, min(event_id) as first_at from events group by all) group by user_id""")
def dict_lookup_array(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    typed = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"]).alias("types"))
    return typed.select("user_id", F.array_join(arrays.distinct_ci(arrays.lookup(F.col("types"), {"click": "Tap", "tap": "Tap", "view": "Look"})), ",").alias("kinds"))


@Q("select p_type, count(*) as n from part group by all order by n desc, p_type limit 10")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    from vacatia.operators import stats

    return stats.top(table(spark, d, "part"), "p_type", 10)


@Q("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25 offset 50")
def paginate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(50).limit(25)


_TIER = "case when o_orderstatus = 'O' then 1 when o_orderstatus = 'F' and o_orderdate < timestamp '1997-01-01' then 2 end"


@Q(f"""select o_orderkey, tier from (select o_orderkey, o_orderdate, {_TIER} as tier from orders) where tier is not null
    order by tier, case when tier = 1 then -epoch_us(o_orderdate) else epoch_us(o_orderdate) end, o_orderkey limit 200""")
def priority_queue(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when(F.col("o_orderstatus") == "O", 1).when((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")), 2)
    q = table(spark, d, "orders").select("o_orderkey", "o_orderdate", tier.alias("tier")).filter("tier is not null")
    return q.orderBy("tier", F.when(F.col("tier") == 1, F.col("o_orderdate")).desc_nulls_last(), F.when(F.col("tier") == 2, F.col("o_orderdate")).asc_nulls_last(), "o_orderkey").limit(200).select("o_orderkey", "tier")


@Q("""select event_id, event_type, (event_id % 7) as retries from events where event_type in ('error', 'view') and (event_type <> 'error' or event_id % 7 < 5)
    order by event_type <> 'view', ts, event_id limit 100""")
def raw_queue(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("retries", F.col("event_id") % 7).filter("event_type in ('error', 'view') and (event_type <> 'error' or retries < 5)")
    return e.orderBy(F.col("event_type") != "view", "ts", "event_id").limit(100).select("event_id", "event_type", "retries")


@Q("select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by md5('42:' || doc_id), doc_id) as n from documents) where n <= 30")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    order = F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")).cast("binary"))
    n = F.row_number().over(W.partitionBy("lang").orderBy(order, "doc_id"))
    return table(spark, d, "documents").select("doc_id", "lang").withColumn("n", n).filter("n <= 30").drop("n")


@Q("select event_id, user_id, ts from events where event_type = 'error' order by ts desc nulls last, event_id limit 5")
def last_failed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter("event_type = 'error'").select("event_id", "user_id", "ts").orderBy(F.desc_nulls_last("ts"), "event_id").limit(5)


@Q("select event_type, max_by(event_id, (ts, event_id)) as event_id, max(ts) as ts from events group by event_type")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


@Q("select event_id, user_id from events where ts = (select max(ts) from events where event_type = 'error')")
def scalar_subquery(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("vacatia_events")
    return spark.sql("select event_id, user_id from vacatia_events where ts = (select max(ts) from vacatia_events where event_type = 'error')")


@Q("""select 'both' as side, count(*) as n from (select doc_id from documents intersect select doc_id from labels) union all
    select 'only_documents', count(*) from (select doc_id from documents except select doc_id from labels)""")
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    one = lambda x, name: x.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return one(a.intersect(b), "both").union(one(a.subtract(b), "only_documents"))


@Q("""select c_custkey as id, c_name as name, c_mktsegment as segment, 'customer' as origin from customer union all by name select s_suppkey as id, s_name as name, 'supplier' as origin from supplier""")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("origin"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s, allowMissingColumns=True)


@Q("select event_type, event_id from events qualify row_number() over (partition by event_type order by event_id) <= 3")
def first_examples(spark: SparkSession, d: str) -> DataFrame:
    return quality.examples(table(spark, d, "events"), "event_type", "event_id")


@Q("""select doc_id, pos::int as pos, line from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)
    where line <> '' qualify row_number() over (partition by doc_id, line order by pos) > 1""")
def duplicate_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("line <> ''")
    again = F.row_number().over(W.partitionBy("doc_id", F.xxhash64("line"), "line").orderBy("pos"))
    return lines.withColumn("n", again).filter("n > 1").drop("n")


@Q("""with s as (select user_id, ts, event_id, event_type = 'error' as bad, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, event_type = 'error' order by ts, event_id) as g from events)
    select user_id, min(event_id) as first_event, count(*) as run from s where bad group by user_id, g having count(*) >= 2""")
def error_runs(spark: SparkSession, d: str) -> DataFrame:
    bad, order = F.col("event_type") == "error", ["ts", "event_id"]
    island = F.row_number().over(W.partitionBy("user_id").orderBy(*order)) - F.row_number().over(W.partitionBy("user_id", "bad").orderBy(*order))
    runs = table(spark, d, "events").withColumn("bad", bad).withColumn("g", island).filter("bad").groupBy("user_id", "g").agg(F.min("event_id").alias("first_event"), F.count("*").alias("run"))
    return runs.filter("run >= 2").select("user_id", "first_event", "run")


@Q("""select user_id, event_id, value < coalesce(last_value(nullif(value, 0) ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), value) as stale from events""")
def stale_steps(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    before = F.last(F.nullif(F.col("value"), F.lit(0.0)), True).over(w)
    return table(spark, d, "events").select("user_id", "event_id", (F.col("value") < F.coalesce(before, F.col("value"))).alias("stale"))


@Q("""select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderstatus = 'O' and (contains(lower(o_orderpriority), 'urgent') or contains(o_orderkey::varchar, '77')) order by o_orderkey limit 50 offset 10""")
def ledger_search(spark: SparkSession, d: str) -> DataFrame:
    hit = F.contains(F.lower("o_orderpriority"), F.lit("urgent")) | F.contains(F.col("o_orderkey").cast("string"), F.lit("77"))
    return table(spark, d, "orders").filter((F.col("o_orderstatus") == "O") & hit).select("o_orderkey", "o_orderstatus", "o_orderpriority").orderBy("o_orderkey").offset(10).limit(50)


@Q("""with u as (select user_id, event_type, ts, event_id, 1 as side from events where event_id % 3 = 0 union all select user_id, event_type, ts, event_id, 2 from events where event_id % 3 = 1)
    select user_id, event_type, event_id, side from u qualify row_number() over (partition by user_id order by (event_type = 'purchase') desc, ts desc, event_id desc) = 1""")
def ledger_fusion(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    both = e.filter("event_id % 3 = 0").withColumn("side", F.lit(1)).union(e.filter("event_id % 3 = 1").withColumn("side", F.lit(2)))
    best = F.max_by(F.struct("event_type", "event_id", "side"), F.struct(F.col("event_type") == "purchase", "ts", "event_id"))
    return both.groupBy("user_id").agg(best.alias("r")).select("user_id", "r.event_type", "r.event_id", "r.side")


@Q("""select user_id, event_id, h, 'v' || version as version from (select user_id, event_id, event_type as h, sum(case when same then 0 else 1 end) over (partition by user_id order by ts, event_id) as version
    from (select *, coalesce(event_type = lag(event_type) over (partition by user_id order by ts, event_id), false) as same from events))""")
def cdc_versions(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("same", F.coalesce(F.col("event_type") == F.lag("event_type").over(w), F.lit(False)))
    version = F.sum(F.when(F.col("same"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0))
    return e.select("user_id", "event_id", F.col("event_type").alias("h"), F.concat(F.lit("v"), version.cast("string")).alias("version"))


@Q("""with h as (select doc_id, source, md5(text) as h from documents) select doc_id, min(o) as repost_of from (select a.doc_id, b.doc_id as o from h a join h b on a.h = b.h and b.doc_id < a.doc_id) group by doc_id""")
def repost_of(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("repost_of"))
    return docs.join(first, "h").filter("doc_id > repost_of").select("doc_id", "repost_of")


@Q("""with scans as (select distinct ts::date as day from events), seen as (select user_id, max(ts::date) as last_seen from events group by user_id)
    select user_id, last_seen::varchar as last_seen, (select count(*) from scans where day > last_seen) as misses, case when (select count(*) from scans where day > last_seen) >= 3 then 'CLOSED' else 'OPEN' end as status from seen""")
def miss_counter(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    # full scans after each day: a running count over days, not a join of users with days
    after = e.select("day").distinct().withColumn("misses", F.row_number().over(W.orderBy(F.desc("day"))) - 1)
    seen = e.groupBy("user_id").agg(F.max("day").alias("last_seen")).join(after, F.col("last_seen") == F.col("day"))
    return seen.select("user_id", F.col("last_seen").cast("string").alias("last_seen"), F.col("misses").cast("bigint").alias("misses"), F.when(F.col("misses") >= 3, "CLOSED").otherwise("OPEN").alias("status"))


@Q("""select user_id, event_id, (date_diff('second', ts, (select max(ts) from events)) / 86400.0 >= 21) as due from events where event_type = 'view'""")
def recheck_due(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    now = e.agg(F.max("ts").alias("now"))
    age = (F.unix_seconds(F.col("now").cast("timestamp")) - F.unix_seconds(F.col("ts").cast("timestamp"))) / 86400.0
    return e.filter("event_type = 'view'").crossJoin(F.broadcast(now)).select("user_id", "event_id", (age >= 21).alias("due"))


@Q("""select count(*) filter (where side = 'local') as local_rows, max(ts) filter (where side = 'remote') > max(ts) filter (where side = 'local') as remote_newer,
    count(distinct user_id) filter (where side = 'remote' and user_id not in (select user_id from events where event_id % 5 = 0)) as lacking
    from (select *, case when event_id % 5 = 0 then 'local' else 'remote' end as side from events)""")
def push_guard(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    local, remote = e.filter("event_id % 5 = 0"), e.filter("event_id % 5 <> 0")
    lacking = remote.select("user_id").distinct().join(local.select("user_id"), "user_id", "left_anti").agg(F.count("*").alias("lacking"))
    a = local.agg(F.count("*").alias("local_rows"), F.max("ts").alias("a"))
    return a.crossJoin(remote.agg(F.max("ts").alias("b"))).crossJoin(lacking).select("local_rows", (F.col("b") > F.col("a")).alias("remote_newer"), "lacking")
