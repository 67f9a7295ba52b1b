"""URL rules by a sorted digest array.

A list of (host, path, verdict) rules is turned into 64-bit xxhash keys of host + path, sorted, beside the full strings, in
files of a range of digests each, which Spark hands to every executor, where they are memory-mapped. For a url, every suffix
of its host at a dot (and, for each path length that some rule has, the prefix of its path) is a possible rule; their
digests are probed by vectorised binary search in the file of their range, and the stored string confirms a hit, so that a
collision of digests can't decide. The longest confirmed rule wins.

A list may be given as tuples or as a table (host, path, verdict); a table is sorted by Spark and comes to the driver a file at
a time. Of a rule that is listed twice, the smallest verdict counts (allow before block).

Cases: a null url or one without :// has an empty host and path and no rule; null or repeated ids keep a row each; a very
long url is probed as any other; an empty table gives an empty result; extra columns are not read; an empty list leaves
every row to the default.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.common import lean, materialize, table, work_dir

#: Rules that one array file holds about (8 bytes of digest each, 8 of offset, the strings beside), and bytes that the
#: driver hands on at a time.
MOST_RULES, CHUNK = 5_000_000, 8 << 20

# The rules of the query, as (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_MAPPED: dict[str, tuple] = {}


def digest_of(c: Column) -> Column:
    return F.xxhash64(c)


def write_arrays(spark: SparkSession, rules: DataFrame | Iterable[tuple[str, str, str]], digest: Callable[[Column], Column] = digest_of) -> tuple[list[str], list[int], list[int]]:
    """Write the sorted arrays to the shared folder and have Spark hand them to all executors; their file names, the first
    digest of each, and the lengths of the rules' paths."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")
    named = rules.select(F.concat("host", "path").alias("rule"), F.length("path").alias("n"), "verdict").groupBy("rule").agg(F.min("verdict").alias("verdict"), F.collect_set("n").alias("n"))
    named = materialize(named.withColumn("digest", digest(F.col("rule"))), "rules")
    n = named.count()
    lengths = sorted(r[0] for r in named.select(F.explode("n")).distinct().collect())  # no more than a path is long
    parts = max(1, -(-n // MOST_RULES))
    cuts = named.approxQuantile("digest", [i / parts for i in range(1, parts)], 0.01) if parts > 1 else []
    edges = [-(1 << 63), *sorted({int(c) for c in cuts} - {-(1 << 63)}), None]
    names, firsts = [], []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        mine = named.filter((F.col("digest") >= F.lit(low)) & (F.lit(True) if high is None else F.col("digest") < F.lit(high)))
        part = mine.orderBy("digest", "rule").select("digest", "rule", "verdict").toArrow().combine_chunks()
        if not part.num_rows:
            continue
        strings = part.column("rule").combine_chunks().cast(pa.large_string())
        offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
        head = np.array([part.num_rows], np.int64)
        blocks = np.asarray(pc.equal(part.column("verdict"), "block").combine_chunks().cast(pa.uint8()))
        name = f"url-rules-{uuid.uuid4().hex}.bin"
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/vacatia/{name}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        for x in (head, np.asarray(part.column("digest")), offsets - offsets[0], np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], blocks):
            data = memoryview(np.ascontiguousarray(x)).cast("B")
            for i in range(0, len(data), CHUNK):
                out.write(bytearray(data[i : i + CHUNK]))
        out.close()
        spark.sparkContext.addFile(path.toString())
        names.append(name)
        firsts.append(low)
    return names, firsts, lengths


def _mapped(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Views on the memory-mapped file: digests, offsets, the strings' bytes, and whether a rule blocks."""
    if name not in _MAPPED:
        raw = np.memmap(SparkFiles.get(name), np.uint8, "r")
        n = int(raw[:8].view(np.int64)[0])
        digests, offsets = raw[8 : 8 + 8 * n].view(np.int64), raw[8 + 8 * n : 16 + 16 * n].view(np.int64)
        end = 16 + 16 * n
        _MAPPED[name] = digests, offsets, raw[end : end + int(offsets[-1])], raw[end + int(offsets[-1]) :]
    return _MAPPED[name]


def _probe(name: str, keys: pa.Array, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in keys of those that are rules of the file, and whether they block. keys have the given digests."""
    have, offsets, strings, blocks = _mapped(name)
    at = np.searchsorted(have, digests, "left")
    some = np.flatnonzero(have[np.minimum(at, len(have) - 1)] == digests)
    at = at[some]
    found, verdict = [], []
    while len(some):  # equal digests stand side by side
        length = offsets[at + 1] - offsets[at]
        start = np.concatenate([[0], np.cumsum(length)])
        data = strings[np.repeat(offsets[at] - start[:-1], length) + np.arange(start[-1])]
        stored = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(start.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
        same = np.asarray(pc.equal(stored, keys.take(pa.array(some)).cast(pa.large_string())))
        found.append(some[same])
        verdict.append(blocks[at[same]])
        some, at = some[~same], at[~same] + 1
        on = at < len(have)
        some, at = some[on], at[on]
        on = have[at] == digests[some]
        some, at = some[on], at[on]
    return (np.concatenate(found), np.concatenate(verdict)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint8))


def judge(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url", key: str = "page_id", digest: Callable[[Column], Column] = digest_of) -> DataFrame:
    """(key, host, path, rule, verdict) of every row. No shuffle; one narrow pass."""
    names, firsts, lengths = write_arrays(pages.sparkSession, rules, digest)
    parts = pages.select(F.col(key).alias("key"), F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit("")).alias("rest")).select(
        "key",
        F.translate(F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    # possible rules: suffixes of the host with beginnings of the path
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda n: F.concat(h, F.substring(F.col("path"), F.lit(1), n)))))
    parts = parts.withColumn("keys", F.when(F.col("host") != "", keys).otherwise(F.array().cast("array<string>")))
    parts = parts.withColumn("digests", F.transform("keys", digest))
    edges = np.array(firsts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, digests = b.column("keys").flatten(), np.asarray(b.column("digests").flatten(), np.int64)
            row = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(b.column("keys")), np.int64))
            file = np.searchsorted(edges, digests, "right") - 1
            hits, blocks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
            for f in np.unique(file[file >= 0]).tolist():
                own = np.flatnonzero(file == f)
                found, verdict = _probe(names[f], keys.take(pa.array(own)), digests[own])
                hits.append(own[found])
                blocks.append(verdict)
            hit, block = np.concatenate(hits), np.concatenate(blocks)
            length = np.asarray(pc.utf8_length(keys.take(pa.array(hit))), np.int64)
            order = np.lexsort((-length, row[hit]))
            first = order[np.concatenate([[True], np.diff(row[hit][order]) != 0])[: len(order)]]
            rule = np.full(b.num_rows, -1)
            rule[row[hit[first]]] = hit[first]
            verdict = np.full(b.num_rows, default, object)
            verdict[row[hit[first]]] = np.where(block[first] == 1, "block", "allow")
            out = keys.take(pa.array(rule, mask=rule < 0))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("host"), b.column("path"), out, pa.array(verdict, pa.string())], [key, "host", "path", "rule", "verdict"])

    kind = dict(parts.dtypes)["key"]
    return parts.mapInArrow(lean(run), f"`{key}` {kind}, host string, path string, rule string, verdict string")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages against the four rules; the method's own verdict for the rest is allow."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)


def oracle() -> str:
    def fits(h: str, p: str) -> str:
        return f"((host = '{h}' or host like '%.{h}') and path[1:{len(p)}] = '{p}')"

    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"when {fits(h, p)} then '{h}{p}'" for h, p, _ in order)
    verdict = " ".join(f"when {fits(h, p)} then '{v}'" for h, p, v in order)
    return f"""with rest as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as r from pages),
    parts as (select page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest)
    select page_id, host, path, case {rule} end as rule, case {verdict} else 'allow' end as verdict from parts"""
