"""WARC fixity audit of two replicas by Merkle trees.

Pages are written as WARC records; a record's digest and size are a leaf. Leaves are ordered by page id, and a node covers
FAN ids of the level below, so a node is also an ordered range of offsets: it holds the digest of its children's
digests and the sum of their sizes. The replicas' roots are compared first; only the children of differing nodes are
looked at on the next level, down to the records. Offsets come from the sizes of the siblings before a node.

Cases: null url or html is empty; null ids are one leaf before all others; rows that repeat an id are one leaf, with a digest
of them all; ids may lie as far apart as they can; two empty replicas, or equal ones, give an empty result; a very long page
is one record, hashed where it lies; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.llm.common import discard, materialize, table

FAN_BITS = 4  # 16 children a node


def record(key: str = "page_id", url: str = "url", html: str = "html") -> Column:
    """A page as a WARC response record."""
    body = F.coalesce(F.col(html), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, digest, size) of each page id; id is null for null ids.

    Several records of an id count by the sums of their digests' quarters, which no order changes and which combine before the
    shuffle, so an id with a third of all records is a few numbers a task."""
    rows = pages.select(F.col(key).cast("long").alias("id"), record(key, url, html).alias("r")).select("id", F.sha2(F.col("r").cast("binary"), 256).alias("digest"), F.octet_length("r").cast("long").alias("size"))
    quarters = [F.sum(F.conv(F.substring("digest", 16 * i + 1, 16), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    g = rows.groupBy("id").agg(F.count("*").alias("n"), F.max("digest").alias("one"), F.sha2(F.concat_ws(":", F.count("*"), *quarters).cast("binary"), 256).alias("several"), F.sum("size").alias("size"))
    return g.select("id", F.when(F.col("n") == 1, F.col("one")).otherwise(F.col("several")).alias("digest"), "size")


def tree(primary: DataFrame, replica: DataFrame, levels: int) -> list[DataFrame]:
    """Tables (side, lane, node, digest, size) of each level, the leaves first. Null ids are lane 0, others lane 1; a node
    covers the ids that are equal but for the last FAN_BITS bits a level, and the last level has one node."""
    sides = [x.select(F.lit(side).alias("side"), F.col("id").isNotNull().cast("int").alias("lane"), F.coalesce("id", F.lit(0)).alias("node"), "digest", "size") for side, x in enumerate((primary, replica))]
    level = materialize(sides[0].union(sides[1]), "leaves")
    out = [level]
    for n in range(1, levels + 1):
        up = F.shiftright("node", FAN_BITS) if n < levels else F.lit(0).cast("long")
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))  # at most 16
        text = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["digest"])), ",")
        level = materialize(level.groupBy("side", "lane", up.alias("up")).agg(F.sha2(text.cast("binary"), 256).alias("digest"), F.sum("size").alias("size")).withColumnRenamed("up", "node"), "level")
        out.append(level)
    return out


def audit(primary: DataFrame, replica: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, status, offset_start, offset_end, digest_primary, digest_replica) of every record that differs.

    status: corrupt, missing (from the replica) or extra (in it alone); offsets are of the primary, -1 for extra; a digest is empty where there is no record."""
    sides = [materialize(leaves(x, key, url, html), "records") for x in (primary, replica)]
    lo, hi = sides[0].select("id").union(sides[1].select("id")).agg(F.min("id"), F.max("id")).first()
    levels = 1
    while lo is not None and lo >> FAN_BITS * levels != hi >> FAN_BITS * levels and FAN_BITS * levels < 64:
        levels += 1
    nodes = tree(*sides, levels)

    differ = None
    for depth in range(levels, -1, -1):
        up = F.lit(0).cast("long") if depth >= levels - 1 else F.shiftright("node", FAN_BITS)
        at = nodes[depth].withColumn("up", up)
        if differ is None:
            at = at.withColumn("before", F.lit(0).cast("long"))
            above = "up"  # both lanes lie below one root
        else:
            at = at.join(differ.select("lane", F.col("node").alias("up"), F.col("start").alias("before")), ["lane", "up"])
            above = "lane"
        of = lambda side: F.max(F.when(F.col("side") == side, F.struct("digest", "size")))
        pairs = at.groupBy("lane", "up", "node").agg(of(0).alias("a"), of(1).alias("b"), F.max("before").alias("before"))
        size = F.coalesce(F.col("a.size"), F.lit(0))
        siblings = W.partitionBy(*dict.fromkeys([above, "up"])).orderBy("lane", "node").rowsBetween(W.unboundedPreceding, -1)  # at most 16 rows
        past = F.coalesce(F.sum(size).over(siblings), F.lit(0))
        below = materialize(pairs.withColumn("start", F.col("before") + past).filter(~F.col("a.digest").eqNullSafe(F.col("b.digest"))).select("lane", "node", "a", "b", "start"), "differ")
        if differ is not None:
            discard(differ)
        differ = below
        if differ.isEmpty():
            break
    for used in (*sides, *nodes):
        discard(used)
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    kind = dict(primary.dtypes)[key]
    return differ.select(
        F.when(F.col("lane") == 1, F.col("node")).cast(kind).alias(key),
        status.alias("status"),
        F.when(F.col("a").isNotNull(), F.col("start")).otherwise(-1).alias("offset_start"),
        F.when(F.col("a").isNotNull(), F.col("start") + F.col("a.size")).otherwise(-1).alias("offset_end"),
        F.coalesce("a.digest", F.lit("")).alias("digest_primary"),
        F.coalesce("b.digest", F.lit("")).alias("digest_replica"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with known damage, for the query: some bodies changed, some records gone, some added."""
    html = F.when(F.col("page_id") % 53 == 7, F.concat("html", F.lit("\x00"))).otherwise(F.col("html"))
    kept = pages.filter("page_id % 97 <> 11").select("page_id", "url", html.alias("html"))
    added = pages.filter("page_id % 211 = 5").select((-F.col("page_id")).alias("page_id"), "url", "html")
    return kept.union(added)


def op7_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records against a damaged replica: every differing record, found through the trees."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(pages, damaged(pages))


def oracle() -> str:
    return r"""with a as (select page_id, url, html from pages),
    b as (select page_id, url, case when page_id % 53 = 7 then html || chr(0) else html end as html from pages where page_id % 97 <> 11
          union all select -page_id, url, html from pages where page_id % 211 = 5),
    r as (select side, page_id, 'WARC/1.0' || n || 'WARC-Type: response' || n || 'WARC-Record-ID: <urn:page:' || page_id || '>' || n || 'WARC-Target-URI: ' || coalesce(url, '') || n
            || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(coalesce(html, '')) || n || n || coalesce(html, '') || n || n as rec
          from (select 'a' as side, *, chr(13) || chr(10) as n from a union all select 'b', *, chr(13) || chr(10) from b)),
    d as (select side, page_id, sha256(rec) as digest, strlen(rec) as size from r),
    x as (select page_id, digest, sum(size) over (order by page_id) as past, size from d where side = 'a'),
    y as (select page_id, digest from d where side = 'b')
    select coalesce(x.page_id, y.page_id) as page_id, case when y.digest is null then 'missing' when x.digest is null then 'extra' else 'corrupt' end as status,
        coalesce(x.past - x.size, -1)::bigint as offset_start, coalesce(x.past, -1)::bigint as offset_end, coalesce(x.digest, '') as digest_primary, coalesce(y.digest, '') as digest_replica
    from x full join y on x.page_id = y.page_id where x.digest is distinct from y.digest"""
