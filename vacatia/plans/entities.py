"""Entity resolution, encoding, contracts, streams and vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.functions import classify
from vacatia.functions import terms as T
from vacatia.operators import dedup, encode, quality
from vacatia.plans.registry import Queries, table
from vacatia.streaming import state

QUERIES = Queries()
Q = QUERIES.add


@Q("""with w as (select distinct p_partkey as id, p_brand, unnest(string_split(lower(p_name), ' ')) as word from part), s as (select id, count(*) as n from w group by id)
    select a.id as a, b.id as b, round(count(*) * 1.0 / (any_value(sa.n) + any_value(sb.n) - count(*)), 6) as similarity from w a join w b on a.p_brand = b.p_brand and a.word = b.word and a.id < b.id join s sa on sa.id = a.id join s sb on sb.id = b.id
    group by a.id, b.id having count(*) * 1.0 / (any_value(sa.n) + any_value(sb.n) - count(*)) >= 0.85""")
def fuzzy_pairs_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_pairs(table(spark, d, "part"), ["p_brand"], "p_partkey", "p_name", 0.85, digits=6)


@Q(r"""with t as (select p_partkey as id, p_brand, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[\p{L}\p{N}_][\p{L}\p{N}_]+')) as word from part), tf as (select p_brand, id, word, count(*) as tf from t group by all),
    n as (select p_brand, count(*) as n from part group by p_brand), df as (select p_brand, word, count(*) as df from tf group by all),
    w as (select p_brand, id, word, tf * (ln((1 + n) / (1 + df)) + 1) as w from tf join df using (p_brand, word) join n using (p_brand)), nm as (select id, sqrt(sum(w * w)) as norm from w group by id)
    select a.id as a, b.id as b, round(sum(a.w * b.w) / any_value(na.norm) / any_value(nb.norm), 6) as cosine from w a join w b on a.p_brand = b.p_brand and a.word = b.word and a.id < b.id join nm na on na.id = a.id join nm nb on nb.id = b.id
    group by a.id, b.id having sum(a.w * b.w) / any_value(na.norm) / any_value(nb.norm) >= 0.95""")
def tfidf_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.tfidf_pairs(table(spark, d, "part"), ["p_brand"], "p_partkey", F.concat_ws(" ", "p_name", "p_type"), 0.95, digits=6)


def _postings(spark: SparkSession, d: str) -> DataFrame:
    """Parts as postings: name as title, type as description, brand as company."""
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("description"), F.concat_ws("||", "p_brand", F.split_part("p_type", F.lit(" "), F.lit(1))).alias("block"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice") * 1e4).alias("salary_min_vnd"), F.when(F.col("p_size") > 25, F.col("p_retailprice") * 2e4).alias("salary_max_vnd"), F.lit("header").alias("salary_source"),
        F.split("p_type", " ").alias("skills"), F.array("p_brand").alias("benefits"), F.concat(F.lit("src"), (F.col("p_partkey") % 8).cast("string")).alias("source_platform"),
    )


@Q()
def leader_clusters(spark: SparkSession, d: str) -> DataFrame:
    return dedup.leaders(_postings(spark, d), "block", "id", "title", "description")


@Q()
def golden_records(spark: SparkSession, d: str) -> DataFrame:
    p = _postings(spark, d)
    return dedup.golden(p.join(dedup.leaders(p, "block", "id", "title", "description"), "id"), "leader", "id")


@Q()
def dedup_metrics(spark: SparkSession, d: str) -> DataFrame:
    per = leader_clusters(spark, d).groupBy("leader").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("before"), F.count("*").alias("after"), F.count_if(F.col("n") > 1).alias("clusters"), F.round(100.0 * (F.sum("n") - F.count("*")) / F.sum("n"), 2).alias("reduction_pct"))


_STATUS = ("F", "O", "P")


@Q("select o_orderkey, " + ", ".join(f"(o_orderstatus = '{v}')::tinyint as status__{v.lower()}" for v in _STATUS) + ", coalesce(case o_orderpriority when '1-URGENT' then 5 when '2-HIGH' then 4 end, -1)::tinyint as priority_ord from orders")
def onehot(spark: SparkSession, d: str) -> DataFrame:
    ordinal = F.when(F.col("o_orderpriority") == "1-URGENT", "Trưởng nhóm/Quản lý").when(F.col("o_orderpriority") == "2-HIGH", "Senior").otherwise("Chưa rõ")
    return table(spark, d, "orders").select("o_orderkey", *encode.one_hot(F.col("o_orderstatus"), "status", list(_STATUS)), classify.ordinal(ordinal).alias("priority_ord"))


@Q("""with w as (select distinct p_partkey, lower(unnest(string_split(p_type, ' '))) as s from part), v as (select s from w group by s having count(*) >= 20 order by count(*) desc, s limit 200)
    select p_partkey, string_agg(s, ',' order by s) as held, (count(*) - count(*) filter (where s in (select s from v)))::int as others from w group by p_partkey""")
def multihot_topk(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("items"))
    slugs = [s for s, _ in encode.vocabulary(p, F.col("items"), T.SKILL_MIN_COUNT, T.SKILL_MOST)]
    wide = p.select("p_partkey", *encode.multi_hot(F.col("items"), "skill", slugs))
    held = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"skill__{s}") == 1, F.lit(s)) for s in slugs])))
    return wide.select("p_partkey", F.array_join(held, ",").alias("held"), F.col("skills__other_count").alias("others"))


@Q("select doc_id, coalesce(quality, -1) as quality, (quality is null)::tinyint as quality__missing, (toxic is null)::tinyint as toxic__missing from documents left join labels using (doc_id)")
def numeric_missing(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    x = j.select("doc_id", *encode.numeric(["quality", "toxic"]))
    return x.select("doc_id", F.coalesce(F.col("quality").cast("int"), F.lit(-1)).alias("quality"), "quality__missing", "toxic__missing")


@Q("""select l_orderkey, l_linenumber, month(o_orderdate)::int as posted_month, case when l_shipdate >= o_orderdate then date_diff('day', o_orderdate::date, l_shipdate::date) else -1 end::int as days_to_deadline, (l_shipdate < o_orderdate)::tinyint as days__missing from lineitem join orders on l_orderkey = o_orderkey""")
def temporal_features(spark: SparkSession, d: str) -> DataFrame:
    from vacatia.functions.dates import days_between

    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    n = l.withColumn("n", days_between(F.col("l_shipdate"), F.col("o_orderdate")))
    return n.select("l_orderkey", "l_linenumber", F.month("o_orderdate").alias("posted_month"), F.coalesce("n", F.lit(-1)).alias("days_to_deadline"), F.col("n").isNull().cast("byte").alias("days__missing"))


@Q("select count(*) as rows_in, count(*) filter (where n_chars >= 500) as rows_out, count(*) filter (where n_chars < 500) as dropped from documents")
def conserved_step(spark: SparkSession, d: str) -> DataFrame:
    """A filter step whose rows in, out and dropped are counted in its own pass, and must add up."""
    r = quality.StepReport("stub")
    docs = r.count(table(spark, d, "documents").select("doc_id", "n_chars"), "in")
    docs = r.count(docs, "short", F.col("n_chars") < 500, "drop")
    r.count(docs.filter("n_chars >= 500"), "out").write.format("noop").mode("overwrite").save()
    r.check()
    n = r.counts()
    return spark.createDataFrame([(n["in"], n["out"], n["short"])], "rows_in long, rows_out long, dropped long")


@Q("""select user_id, min(ts) as first_at, max(ts) as last_at, max_by(event_id, (ts, event_id)) as last_event, count(*) as seen, case when bool_or(event_type = 'purchase') then 'DONE' else 'PENDING' end as status from events group by user_id""")
def stream_state_latest(spark: SparkSession, d: str) -> DataFrame:
    stream = state.events(spark, f"{d}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    return state.merge_stream(stream, "ledger", state.register)


@Q("select user_id, event_type, count(*) as n from (select distinct user_id, event_type, ts::date as day from events) group by all")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    stream = state.events(spark, f"{d}/events.parquet").select("user_id", "event_type", F.to_date("ts").alias("day")).dropDuplicates(["user_id", "event_type", "day"])
    return state.to_table(stream, "manifest").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@Q("""select time_bucket(interval 1 hour, ts) as hour, event_type, count(*) as n from events group by all""")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Extension, not in the reference: hourly counts, late rows merged into the hour's state."""
    hour = lambda b: b.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"))
    add = lambda old, b: hour(b) if old is None else old.unionByName(hour(b)).groupBy("hour", "event_type").agg(F.sum("n").alias("n"))
    return state.merge_stream(state.events(spark, f"{d}/events.parquet"), "hours", add)


@Q("""with s as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 55 minute then 0 else 1 end as fresh from events), g as (select user_id, ts, sum(fresh) over (partition by user_id order by ts) as k from s)
    select user_id, min(ts) as started, count(*) as n from g group by user_id, k""")
def session_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Runs of a user's events with less than 55 minutes between them."""
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    g = e.groupBy("user_id", F.session_window("ts", "55 minutes").alias("w")).agg(F.min("ts").alias("started"), F.count("*").alias("n"))
    return g.select("user_id", F.col("started").cast("timestamp_ntz").alias("started"), "n")


@Q("""select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.embedding, b.embedding), 4) as cosine from embeddings a join embeddings b on a.label = b.label and b.vec_id = a.vec_id + 1""")
def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Extension, not in the reference: similarity of neighbouring vectors of a class."""
    v = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), "label", F.col("vec_id").alias("b"), F.col("x").alias("y"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda acc, z: acc + z)
    j = v.join(other, ["vec_id", "label"])
    return j.select(F.col("vec_id").alias("a"), "b", F.round(dot("x", "y") / F.sqrt(dot("x", "x")) / F.sqrt(dot("y", "y")), 4).alias("cosine"))


@Q("""with runs as (select event_type as dag, count(*) filter (where value < 20) as failed from events group by 1), o as (select o_orderpriority as queue, count(*) as n from orders where o_orderstatus = 'P' group by 1)
    select 'failed_tasks' as alert, dag as subject, failed as n from runs where failed > 0 union all select 'backlog', queue, n from o where n > 5 and queue <> '5-LOW'""")
def alerts(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "events").groupBy(F.col("event_type").alias("subject")).agg(F.count_if(F.col("value") < 20).alias("n")).filter("n > 0").select(F.lit("failed_tasks").alias("alert"), "subject", "n")
    backlog = table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_orderpriority").alias("subject")).agg(F.count("*").alias("n")).filter("n > 5").select(F.lit("backlog").alias("alert"), "subject", "n")
    acknowledged = spark.createDataFrame([("backlog", "5-LOW")], "alert string, subject string")
    return reduce(DataFrame.union, (failed, backlog)).join(F.broadcast(acknowledged), ["alert", "subject"], "left_anti")


@Q(r"""select layer, count(*) as n, count(*) filter (where not regexp_matches(day, '^\d{4}-\d{2}-\d{2}$')) as bad_dates from (select o_orderpriority as layer, case when o_orderkey % 10 = 0 then 'tmp' else o_orderdate::date::varchar end as day from orders) group by layer""")
def layout_audit(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 10 == 0, "tmp").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = F.concat_ws("/", F.lit("raw"), "o_orderpriority", day, F.concat("o_orderkey", F.lit("_v1.json")))
    keys = table(spark, d, "orders").select(path.alias("p"))
    return keys.groupBy(F.split_part("p", F.lit("/"), F.lit(2)).alias("layer")).agg(F.count("*").alias("n"), F.count_if(~F.split_part("p", F.lit("/"), F.lit(3)).rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("bad_dates"))
