"""Counts, rates, quantiles and other profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.operators import quality, stats
from vacatia.plans.registry import Queries, table

QUERIES = Queries()
Q = QUERIES.add


@Q("""select coalesce(o_orderpriority, '(all)') as source, count(*) filter (where o_orderstatus = 'O') as pending, count(*) filter (where o_orderstatus = 'F') as done, count(*) filter (where o_orderstatus = 'P') as recheck,
    count(*) as total, round(100.0 * count(*) filter (where o_orderstatus = 'F') / greatest(count(*), 1), 1) as done_pct from orders group by rollup (o_orderpriority)""")
def status_pivot(spark: SparkSession, d: str) -> DataFrame:
    n = lambda v: F.count_if(F.col("o_orderstatus") == v)
    g = table(spark, d, "orders").rollup("o_orderpriority")
    return g.agg(n("O").alias("pending"), n("F").alias("done"), n("P").alias("recheck"), F.count("*").alias("total"), F.round(100.0 * n("F") / F.greatest(F.count("*"), F.lit(1)), 1).alias("done_pct")).select(
        F.coalesce("o_orderpriority", F.lit("(all)")).alias("source"), "pending", "done", "recheck", "total", "done_pct"
    )


@Q("""select n_name, count(*) filter (where o_orderstatus = 'O') as pending, count(*) filter (where o_orderstatus = 'F' and o_orderdate < timestamp '1998-01-01') as recheck_due,
    count(*) filter (where o_orderstatus = 'F' and o_orderdate >= timestamp '1998-01-01') as done from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name""")
def queue_summary(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    # due orders per customer first, so that the join moves a row a customer and not a row an order
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    per = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "O").alias("pending"), F.count_if((F.col("o_orderstatus") == "F") & old).alias("recheck_due"), F.count_if((F.col("o_orderstatus") == "F") & ~old).alias("done"))
    return per.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(*[F.sum(x).alias(x) for x in ("pending", "recheck_due", "done")])


_FILL = "select '{0}' as field, count(*) filter (where {1}) as filled, round(100.0 * count(*) filter (where {1}) / count(*), 1) as pct from documents d left join labels l using (doc_id)"


@Q(" union all ".join(_FILL.format(*x) for x in (("text", "trim(d.text) <> ''"), ("lang", "d.lang is not null"), ("quality", "l.quality is not null"), ("toxic", "l.toxic is not null and l.toxic <> 0"))))
def fill_rate(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "lang", (F.trim("text") == "").alias("blank")).join(table(spark, d, "labels"), "doc_id", "left")
    return stats.fill_rates(j, {"text": F.coalesce("blank", F.lit(True)), "lang": F.col("lang").isNull(), "quality": F.col("quality").isNull(), "toxic": F.col("toxic").isNull() | (F.col("toxic") == 0)})


@Q("""select field, coalesce(source, '(all)') as source, sum(filled)::bigint as filled, sum(missing)::bigint as missing, round(100.0 * sum(filled) / (sum(filled) + sum(missing)), 2) as pct from (
    select source, 'quality' as field, (quality is not null)::int as filled, (quality is null)::int as missing from documents left join labels using (doc_id)
    union all select source, 'toxic', coalesce(toxic = 1, false)::int, (not coalesce(toxic = 1, false))::int from documents left join labels using (doc_id)) group by grouping sets ((field, source), (field))""")
def completeness_rollup(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    per = j.groupBy("source").agg(F.count("*").alias("n"), F.count("quality").alias("quality"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    long = per.unpivot(["source", "n"], ["quality", "toxic"], "field", "filled")
    out = long.rollup("field", "source").agg(F.sum("filled").alias("filled"), F.sum(F.col("n") - F.col("filled")).alias("missing")).filter("field is not null")
    return out.select("field", F.coalesce("source", F.lit("(all)")).alias("source"), "filled", "missing", F.round(100.0 * F.col("filled") / (F.col("filled") + F.col("missing")), 2).alias("pct"))


@Q("""with r as (select p_brand as source, field, avg(v) as rate from (select p_brand, unnest([{'f': 'large', 'v': (p_size > 20)::int}, {'f': 'dear', 'v': (p_retailprice > 1500)::int}, {'f': 'small', 'v': (p_size <= 5)::int}]) as x from part) t, lateral (select x.f as field, x.v as v) group by all)
    select field, count(*) filter (where rate >= 0.5) as sources, coalesce(string_agg(source, ',' order by source) filter (where rate < 0.5), '') as missing_in from r group by field having count(*) filter (where rate >= 0.5) >= 1""")
def field_matrix(spark: SparkSession, d: str) -> DataFrame:
    tests = {"large": F.col("p_size") > 20, "dear": F.col("p_retailprice") > 1500, "small": F.col("p_size") <= 5}
    per = table(spark, d, "part").groupBy(F.col("p_brand").alias("source")).agg(*[F.avg(t.cast("int")).alias(k) for k, t in tests.items()])
    long = per.unpivot("source", list(tests), "field", "rate")
    missing = F.array_join(F.array_sort(F.collect_list(F.when(F.col("rate") < 0.5, F.col("source")))), ",")
    return long.groupBy("field").agg(F.count_if(F.col("rate") >= 0.5).alias("sources"), missing.alias("missing_in")).filter("sources >= 1")


@Q("""with p as (select source, count(*) as n, round(100.0 * count(quality) / count(*), 1) as pct from documents left join labels using (doc_id) group by source)
    select round(sum(pct * n) / sum(n), 4) as weighted_pct, sum(n)::bigint as rows_out, count(*) as sources from p""")
def weighted_fill(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    per = j.groupBy("source").agg(F.count("*").alias("n"), F.round(100.0 * F.count("quality") / F.count("*"), 1).alias("pct"))
    return per.agg(F.round(F.sum(F.col("pct") * F.col("n")) / F.sum("n"), 4).alias("weighted_pct"), F.sum("n").alias("rows_out"), F.count("*").alias("sources"))


_INV = "select '{0}' as field, count(*) - count({0}) as nulls, round(100.0 * (count(*) - count({0})) / count(*), 2) as null_pct, count(distinct {0}) as distinct_values from (select e.*, l.quality, l.toxic from events e left join labels l on l.doc_id = e.user_id and l.quality = 1)"


@Q(" union all ".join(_INV.format(c) for c in ("event_type", "user_id", "value", "quality", "toxic")))
def field_inventory(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "labels").filter("quality = 1").withColumnRenamed("doc_id", "user_id")
    e = table(spark, d, "events").join(l, "user_id", "left")
    cols = ("event_type", "user_id", "value", "quality", "toxic")
    # one aggregation a column: several distinct counts at once would multiply the rows instead
    one = lambda c: e.agg((F.count("*") - F.count(c)).alias("nulls"), F.round(100.0 * (F.count("*") - F.count(c)) / F.count("*"), 2).alias("null_pct"), F.count_distinct(c).alias("distinct_values")).select(F.lit(c).alias("field"), "*")
    out = one(cols[0])
    for c in cols[1:]:
        out = out.union(one(c))
    return out


@Q("select quantile_cont(l_extendedprice, 0.01) as p1, quantile_cont(l_extendedprice, 0.25) as p25, quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.75) as p75, quantile_cont(l_extendedprice, 0.99) as p99 from lineitem")
def quantiles(spark: SparkSession, d: str) -> DataFrame:
    return stats.quantiles(table(spark, d, "lineitem"), "l_extendedprice")


@Q("select c_mktsegment, median(c_acctbal) as median_balance, count(*) as n from customer group by c_mktsegment")
def group_median(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(F.median("c_acctbal").alias("median_balance"), F.count("*").alias("n"))


@Q("select round(skewness(l_extendedprice), 6) as skewness, round(kurtosis(l_extendedprice), 6) as kurtosis from lineitem")
def moments(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").agg(*stats.moments("l_extendedprice"))
    return m.select(F.round("skewness", 6).alias("skewness"), F.round("kurtosis", 6).alias("kurtosis"))


@Q("""with r as (select l_quantity as q, l_extendedprice as p, rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as rq,
    rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as rp from lineitem) select round(corr(q, p), 6) as pearson, round(corr(rq, rp), 6) as spearman from r""")
def correlations(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    r = stats.average_rank(stats.average_rank(df, "l_quantity", "rq"), "l_extendedprice", "rp")
    return r.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("pearson"), F.round(F.corr("rq", "rp"), 6).alias("spearman"))


_EDGES = [0.0, 50000.0, 100000.0, 150000.0, 200000.0, 300000.0, 1000000.0]


@Q(" union all ".join(f"select {i} as bin, {a} as low, {b} as high, count(*) filter (where o_totalprice >= {a} and o_totalprice < {b}) as n from orders" for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:], strict=False), 1)))
def histogram_edges(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(table(spark, d, "orders"), "o_totalprice", _EDGES)


@Q("""select kind, count(*) as n from (select case when p_size % 5 = 0 then 'negotiable' when p_size % 5 = 1 then 'usd' when p_size % 5 = 2 then 'up_to' else 'range' end as kind from part) group by kind""")
def salary_kinds(spark: SparkSession, d: str) -> DataFrame:
    from vacatia.functions.money import salary

    r = F.col("p_size") % 5
    text = F.when(r == 0, "Thỏa thuận").when(r == 1, F.concat(F.lit("1,000 - "), F.lit("2,000 USD"))).when(r == 2, F.concat(F.lit("Tới "), F.col("p_size").cast("string"), F.lit(" triệu"))).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" - "), (F.col("p_size") + 5).cast("string"), F.lit(" triệu")))
    s = table(spark, d, "part").select(salary(text).alias("s")).select("s.*")
    kind = F.when(F.col("negotiable"), "negotiable").when(F.col("currency") == "USD", "usd").when(F.col("low").isNull(), "up_to").otherwise("range")
    return s.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@Q("select max(n) * 1.0 / min(n) as ratio from (select count(*) as n from orders group by o_orderpriority)")
def imbalance(spark: SparkSession, d: str) -> DataFrame:
    return stats.top(table(spark, d, "orders"), "o_orderpriority").agg((F.max("n") * 1.0 / F.min("n")).alias("ratio"))


@Q("""select word, count(*) as n, round(100.0 * count(*) / (select count(*) from part), 1) as pct from (select unnest(string_split(p_type, ' ')) as word from part) group by word order by n desc, word limit 10""")
def exploded_topn(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    words = p.select(F.explode(F.split("p_type", " ")).alias("word"))
    total = p.agg(F.count("*").alias("all"))
    return stats.top(words, "word", 10).crossJoin(F.broadcast(total)).select("word", "n", F.round(100.0 * F.col("n") / F.col("all"), 1).alias("pct"))


@Q("select c_nationkey, count(distinct c_mktsegment) as segments, count(distinct c_name) as names from customer group by c_nationkey")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.count_distinct("c_mktsegment").alias("segments"), F.count_distinct("c_name").alias("names"))


@Q("""select h, n, copies from (select md5(text) as h, count(distinct doc_id) as n, count(*) - 1 as copies from documents group by 1 having count(distinct doc_id) > 1)""")
def duplicate_paths(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    return docs.groupBy("h").agg(F.count_distinct("doc_id").alias("n"), (F.count("*") - 1).alias("copies")).filter("n > 1")


@Q("""select split_part(p_name, ' ', 1) as name, count(distinct p_name) as variants from part group by 1 having count(distinct p_name) > 1""")
def name_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("name")).agg(F.count_distinct("p_name").alias("variants")).filter("variants > 1")


@Q("""select source, count(*) as n, avg((length(text) > 200)::int) >= 0.5 and count(distinct md5(text)) * 1.0 / count(*) >= 0.9 and count(*) filter (where lang is null) = 0 as passed,
    round(avg((length(text) > 200)::int), 4) as valid_share, round(count(distinct md5(text)) * 1.0 / count(*), 4) as unique_share from documents group by source""")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "lang", (F.length("text") > 200).cast("int").alias("valid"), F.md5(F.col("text").cast("binary")).alias("h"))
    valid, unique = F.avg("valid"), F.count_distinct("h") * 1.0 / F.count("*")
    passed = (valid >= 0.5) & (unique >= 0.9) & (F.count_if(F.col("lang").isNull()) == 0)
    return docs.groupBy("source").agg(F.count("*").alias("n"), passed.alias("passed"), F.round(valid, 4).alias("valid_share"), F.round(unique, 4).alias("unique_share"))


@Q("""select quality as label, (n_chars > 2000) as said, count(*) as n, count(*) filter (where (n_chars > 2000)::int = quality) as correct from documents join labels using (doc_id) where quality in (0, 1) group by all""")
def rule_accuracy(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", (F.col("n_chars") > 2000).alias("said")).join(table(spark, d, "labels").filter("quality in (0, 1)"), "doc_id")
    return j.groupBy(F.col("quality").alias("label"), "said").agg(F.count("*").alias("n"), F.count_if(F.col("said").cast("int") == F.col("quality")).alias("correct"))


@Q("""select source, round(100.0 * count(*) filter (where toxic = 1) / count(*), 2) as pct, case when 100.0 * count(*) filter (where toxic = 1) / count(*) >= 50 then 'drop' when count(*) filter (where toxic = 1) > 0 then 'review' else 'keep' end as policy
    from documents join labels using (doc_id) group by source""")
def policy_proposal(spark: SparkSession, d: str) -> DataFrame:
    pct = 100.0 * F.count_if(F.col("toxic") == 1) / F.count("*")
    j = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("source").agg(F.round(pct, 2).alias("pct"), F.when(pct >= 50, "drop").when(F.count_if(F.col("toxic") == 1) > 0, "review").otherwise("keep").alias("policy"))


@Q("""select count(*) as rows_, count(*) filter (where contains(url, '://')) as valid_schema, count(*) filter (where not contains(url, '#') and not contains(url, 'ref=')) as clean_url, count(*) filter (where contains(html, '<title>')) as has_title from pages""")
def metadata_audit(spark: SparkSession, d: str) -> DataFrame:
    has = lambda c, s: F.contains(F.col(c), F.lit(s))
    return table(spark, d, "pages").agg(F.count("*").alias("rows_"), F.count_if(has("url", "://")).alias("valid_schema"), F.count_if(~has("url", "#") & ~has("url", "ref=")).alias("clean_url"), F.count_if(has("html", "<title>")).alias("has_title"))


@Q("""select o_custkey, case when bool_or(o_orderstatus = 'P') then 'running' when count(*) filter (where o_orderstatus = 'O') = 0 then 'done' when count(*) filter (where o_orderstatus = 'O') = count(*) then 'fail' else 'partial' end as status,
    min(o_orderdate) as started, max(o_orderdate) as ended from orders group by o_custkey""")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    failed = F.count_if(F.col("o_orderstatus") == "O")
    status = F.when(F.bool_or(F.col("o_orderstatus") == "P"), "running").when(failed == 0, "done").when(failed == F.count("*"), "fail").otherwise("partial")
    return table(spark, d, "orders").groupBy("o_custkey").agg(status.alias("status"), F.min("o_orderdate").alias("started"), F.max("o_orderdate").alias("ended"))


@Q("""select round(100.0 * (1 - sum(a + b + c) * 1.0 / (3 * count(*))), 2) as sparsity_pct from (select contains(p_type, 'STEEL')::int as a, contains(p_type, 'BRASS')::int as b, contains(p_type, 'SMALL')::int as c from part)""")
def sparsity(spark: SparkSession, d: str) -> DataFrame:
    held = sum((F.contains(F.col("p_type"), F.lit(w)).cast("int") for w in ("STEEL", "BRASS", "SMALL")), F.lit(0))
    return table(spark, d, "part").agg(F.round(100.0 * (1 - F.sum(held) * 1.0 / (3 * F.count("*"))), 2).alias("sparsity_pct"))


@Q("""select source, count(*) as n, round(100.0 * count(*) filter (where contains(text, '!!')) / count(*), 1) as shout_pct, round(100.0 * count(*) filter (where contains(text, ' | ')) / count(*), 1) as table_pct,
    (count(*) - count(distinct text[1:300])) as same_start, count(*) filter (where text = upper(text) and text <> lower(text)) as all_caps, max(n_chars) as longest from documents group by source""")
def source_stats(spark: SparkSession, d: str) -> DataFrame:
    has = lambda s: F.count_if(F.contains(F.col("text"), F.lit(s)))
    docs = table(spark, d, "documents").select("source", "n_chars", "text", F.md5(F.substring("text", 1, 300).cast("binary")).alias("start"))
    caps = F.count_if((F.col("text") == F.upper("text")) & (F.col("text") != F.lower("text")))
    # the distinct count runs on a digest; texts take part in plain sums only
    plain = docs.groupBy("source").agg(F.count("*").alias("n"), F.round(100.0 * has("!!") / F.count("*"), 1).alias("shout_pct"), F.round(100.0 * has(" | ") / F.count("*"), 1).alias("table_pct"), caps.alias("all_caps"), F.max("n_chars").alias("longest"))
    starts = docs.groupBy("source").agg((F.count("*") - F.count_distinct("start")).alias("same_start"))
    return plain.join(starts, "source")


@Q("""with d as (select max(ts)::date as today from events) select count(*) filter (where ts::date = today) as today, count(*) filter (where ts::date = today - 1) as yesterday, count(*) as total,
    round(count(*) * 1.0 / count(distinct ts::date), 1) as avg_per_day from events, d""")
def kpi(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    last = days.withColumn("today", F.max("day").over(W.partitionBy()))  # a row a day
    on = lambda k: F.coalesce(F.sum(F.when(F.col("day") == F.date_sub("today", k), F.col("n"))), F.lit(0))
    return last.agg(on(0).alias("today"), on(1).alias("yesterday"), F.sum("n").alias("total"), F.round(F.sum("n") * 1.0 / F.count("*"), 1).alias("avg_per_day"))


@Q("""select c_mktsegment as source, count(*) as rows_, round(100.0 * count(*) filter (where c_acctbal > 0) / count(*), 1) as paid_pct, round(median(c_acctbal), 2) as median_, round(avg(c_acctbal), 2) as mean_, min(c_acctbal) as least, max(c_acctbal) as most from customer group by 1""")
def health_card(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    return table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("source")).agg(
        F.count("*").alias("rows_"), F.round(100.0 * F.count_if(b > 0) / F.count("*"), 1).alias("paid_pct"), F.round(F.median(b), 2).alias("median_"), F.round(F.avg(b), 2).alias("mean_"), F.min(b).alias("least"), F.max(b).alias("most")
    )


@Q("""select * from (select 'error' as level, 'no_title' as issue, regexp_extract(url, '://([^/?#]+)', 1) as subject, count(*) as n from pages where not contains(html, '<title>') group by 3
    union all select 'warn', 'tracked_url', regexp_extract(url, '://([^/?#]+)', 1), count(*) from pages where contains(url, 'ref=') group by 3
    union all select 'info', 'plain_http', regexp_extract(url, '://([^/?#]+)', 1), count(*) from pages where starts_with(url, 'http:') group by 3)""")
def issues(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("url", F.contains(F.col("html"), F.lit("<title>")).alias("titled"), F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))
    rules = (("error", "no_title", ~F.col("titled")), ("warn", "tracked_url", F.contains(F.col("url"), F.lit("ref="))), ("info", "plain_http", F.startswith(F.col("url"), F.lit("http:"))))
    found = [quality.issue(p, level, name, test, "host") for level, name, test in rules]
    rank = F.when(F.col("level") == "error", 0).when(F.col("level") == "warn", 1).otherwise(2)
    return found[0].union(found[1]).union(found[2]).orderBy(rank, "subject")


@Q("""select p_type, n, round(100.0 * sum(n) over (order by n desc, p_type) / sum(n) over (), 1) as running_pct from (select p_type, count(*) as n from part group by 1 order by n desc, p_type limit 10)""")
def pareto_top10(spark: SparkSession, d: str) -> DataFrame:
    return stats.pareto(table(spark, d, "part"), "p_type", 10)


@Q("""with q as (select quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3 from lineitem), f as (select greatest(0, q1 - 1.5 * (q3 - q1)) as low, q3 + 1.5 * (q3 - q1) as high from q)
    select low, high, count(*) filter (where l_extendedprice < low or l_extendedprice > high) as outliers, count(*) filter (where l_extendedprice < low or l_extendedprice > high) / count(*) as share from lineitem, f group by low, high""")
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    return stats.iqr_fences(table(spark, d, "lineitem").select("l_extendedprice"), "l_extendedprice")


@Q("""with q as (select quantile_cont(o_totalprice, 0.01) as a, quantile_cont(o_totalprice, 0.99) as b from orders) select o_orderkey, greatest(least(o_totalprice, b), a) as capped from orders, q""")
def winsorize(spark: SparkSession, d: str) -> DataFrame:
    return stats.winsorize(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "capped").select("o_orderkey", "capped")


@Q("""with q as (select median(o_totalprice) as m, quantile_cont(o_totalprice, 0.25) as a, quantile_cont(o_totalprice, 0.75) as b from orders) select o_orderkey, round((o_totalprice - m) / (b - a), 9) as scaled from orders, q""")
def robust_scale(spark: SparkSession, d: str) -> DataFrame:
    return stats.robust_scale(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "scaled").select("o_orderkey", F.round("scaled", 9).alias("scaled"))


@Q("select l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 9) as log_price from lineitem")
def log1p_price(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.log1p("l_extendedprice"), 9).alias("log_price"))


@Q("""with r as (select o_orderkey, o_totalprice * 500 * 0.8 as lo, o_totalprice * 500 as hi from orders), s as (select *, (lo < 1e6 or lo > 5e8 or hi < 1e6 or hi > 5e8) as suspect from r),
    t as (select o_orderkey, suspect, case when not suspect then lo end as lo, case when not suspect then hi end as hi from s),
    q as (select quantile_cont(coalesce(hi, lo), 0.25) as q1, quantile_cont(coalesce(hi, lo), 0.75) as q3, quantile_cont(lo, 0.01) as l1, quantile_cont(lo, 0.99) as l99, quantile_cont(hi, 0.01) as h1, quantile_cont(hi, 0.99) as h99 from t)
    select o_orderkey, suspect as salary_suspect, coalesce(coalesce(hi, lo) < greatest(0, q1 - 1.5 * (q3 - q1)) or coalesce(hi, lo) > q3 + 1.5 * (q3 - q1), false) as is_outlier_salary,
        round(case when lo is not null then greatest(least(lo, l99), l1) end, 4) as lo_capped, round(ln(1 + case when hi is not null then greatest(least(hi, h99), h1) end), 9) as log_hi from t, q""")
def salary_global(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") * 500 * 0.8).alias("lo"), (F.col("o_totalprice") * 500).alias("hi"), F.lit("").alias("jd"))
    n = stats.normalise_salaries(o, "lo", "hi", "jd")
    return n.select("o_orderkey", "salary_suspect", "is_outlier_salary", F.round("lo_capped", 4).alias("lo_capped"), F.round("log_hi", 9).alias("log_hi"))


@Q("""select p_partkey, case when p_size between 1 and 10 then p_size * 1000 * 25400.0 when p_size > 40 then p_size * 1e7 / 12 else p_size * 1e6 end as fixed from part""")
def salary_input_fix(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    value = F.when(size <= 10, size * 1000.0).when(size > 40, size * 1e7).otherwise(size * 1e6)
    return table(spark, d, "part").select("p_partkey", stats.fix_salary(value, F.when(size > 40, "trả theo năm: 500 triệu / năm")).alias("fixed"))


@Q("select l_orderkey, l_linenumber, least(l_quantity, l_discount * 300) as low, greatest(l_quantity, l_discount * 300) as high from lineitem")
def swap_bounds(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("l_quantity"), F.col("l_discount") * 300
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
