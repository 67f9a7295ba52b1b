"""Raw posting envelopes: {metadata, raw_payload}, one a file, a list of them, or a line each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Folders beside the raw files that hold other things.
SKIPPED = r"/(?:_index|_quality|_listing|_listing_failures)/"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(file, kind: snapshot|batch|not_envelope|broken, item, envelope variant) of all JSON files below a folder.

    Lists give a row an item. Files are read whole, so each should fit an executor's memory; they are one posting or one batch."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path)
    v = files.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v")).filter(~F.col("file").rlike(SKIPPED))
    v = v.withColumn("list", F.expr("try_variant_get(v, '$', 'array<variant>')"))
    kind = F.when(F.col("v").isNull(), "broken").when(F.col("list").isNotNull(), "batch").when(F.expr("try_variant_get(v, '$.metadata', 'variant') is not null or try_variant_get(v, '$._meta', 'variant') is not null"), "snapshot").otherwise("not_envelope")
    v = v.withColumn("kind", kind)
    lists = v.filter("kind = 'batch'").select("file", "kind", F.posexplode("list").alias("item", "envelope"))
    return v.filter("kind <> 'batch'").select("file", "kind", F.lit(0).alias("item"), F.col("v").alias("envelope")).union(lists)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, envelope, broken: first 80 characters of a line that is not JSON)."""
    lines = spark.read.text(path).filter("trim(value) <> ''")
    return lines.select(F.col("value").alias("line"), F.try_parse_json("value").alias("envelope")).withColumn("broken", F.when(F.col("envelope").isNull(), F.substring("line", 1, 80)))


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet with only the columns asked for."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; a byte order mark before the first name is dropped."""
    df = spark.read.option("header", "true").option("encoding", "UTF-8").option("multiLine", "true").csv(path)
    return df.toDF(*[c.removeprefix("﻿") for c in df.columns])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(url_hash, record variant) of a ledger file {"records": {hash: record}}."""
    files = spark.read.option("wholetext", "true").text(path).select(F.try_parse_json("value").alias("v"))
    records = files.select(F.explode(F.expr("try_variant_get(v, '$.records', 'map<string,variant>')")).alias("url_hash", "record"))
    return records


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(layer, files, bytes): what lies in each folder below a path, without reading contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    root = path.rstrip("/").split("/")[-1]
    return files.groupBy(F.regexp_extract("path", rf"/{root}/([^/]+)/", 1).alias("layer")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def postings(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, posting variant) of every JobPosting in JSON-LD scripts: objects, lists and @graph."""
    scripts = pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))).alias("s"))
    v = scripts.select(key, F.try_parse_json("s").alias("v")).filter("v is not null")
    v = v.withColumn("list", F.expr("coalesce(try_variant_get(v, '$.@graph', 'array<variant>'), try_variant_get(v, '$', 'array<variant>'), array(v))"))
    each = v.select(key, F.explode("list").alias("posting"))
    return each.filter(F.expr("try_variant_get(posting, '$.@type', 'string') = 'JobPosting'"))


def load_any(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(file, item, id, payload): postings of files that hold a list, {"jobs": []}, {"records": []} or one object.

    The id is the first of metadata.job_id, id, jobId, job_id; of rows with one id the first (by file and place) stays, rows
    without an id all stay. most takes a preview of that many files."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path)
    v = files.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v")).filter("v is not null and not file rlike 'url_ledger|manifest|session'")
    if most is not None:
        v = v.orderBy("file").limit(most)
    lists = "coalesce(try_variant_get(v, '$', 'array<variant>'), try_variant_get(v, '$.jobs', 'array<variant>'), try_variant_get(v, '$.records', 'array<variant>'), array(v))"
    each = v.select("file", F.posexplode(F.expr(lists)).alias("item", "x"))
    get = lambda p, kind="string": f"try_variant_get(x, '$.{p}', '{kind}')"
    payload = f"coalesce({get('raw_payload', 'variant')}, {get('raw', 'variant')}, {get('listing_response', 'variant')}, x)"
    each = each.withColumn("payload", F.expr(payload)).withColumn("meta_id", F.expr(f"coalesce({get('metadata.job_id')}, {get('_meta.job_id')})"))
    inner = ", ".join(f"try_variant_get(payload, '$.{k}', 'string')" for k in ("id", "jobId", "job_id"))
    rows = each.withColumn("id", F.expr(f"nullif(coalesce(meta_id, {inner}), '')")).drop("x", "meta_id")
    n = F.row_number().over(W.partitionBy("id").orderBy("file", "item"))
    return rows.filter("id is null").unionByName(rows.filter("id is not null").withColumn("_n", n).filter("_n = 1").drop("_n"))


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A database query's rows."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def valid_shape() -> Column:
    """Whether an envelope can be a posting: a source, an id, and a title or name in its payload."""
    have = lambda *paths: "coalesce(" + ", ".join(f"nullif(trim(try_variant_get(envelope, '$.{p}', 'string')), '')" for p in paths) + ") is not null"
    return F.expr(" and ".join((have("metadata.source", "_meta.source"), have("metadata.job_id", "_meta.job_id"), have("raw_payload.title", "raw_payload.jobTitle", "raw_payload['job-title']", "raw.title", "raw.jobTitle"))))
