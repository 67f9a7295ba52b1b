"""MinHash near-duplicates with exact confirmation, and connected components.

1. One pass over the texts gives each document its number of distinct word shingles, a 128-bit digest of the set, many
   universal hash minima, and a key for each band of minima.
2. Documents of equal sets are one class; only classes go on, as numbers, each with the text of its smallest id.
3. Classes that share a band key are a bucket. Each bucket is first compared with one hub, the member that lies in the
   largest buckets, so a group of copies costs as many comparisons as it has members, not their square.
4. Signature verification drops pairs whose minima agree too seldom; the rest is confirmed on the full shingle sets.
5. Components by alternating large-star and small-star.
6. A hub and those near it by signature are a family. Families still in several components get all pairs between those
   components compared, on full sets and in blocks of bounded size, which give back no more links than join components.
   Buckets still in several components get their other pairs compared too, so no link within a bucket is lost.

Groups (buckets, families, vertices, classes) may hold a third of all rows: what is known of a group is joined to parts of it.
Banding misses a pair of similarity 0.8 with probability (1 - 0.8^4)^32, about 5e-8. Shingles are known by 64-bit hashes of
their words' hashes; two shingles of a pair of sets are taken for one with a probability of about 1e-19 each.

Cases: a null or empty text, or one without words, has no shingles and is linked with nothing; fewer words than a shingle
takes make one shingle of all; a null id is never linked, its component is null and it is kept; rows that repeat an id are one
document, linked with all that any of them is linked with; ids may be of any type that has an order; a very long text is a
slice of its own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.common import SPACE, Words, discard, distinct_per_row, join_spread, lean, materialize, mix, slices, table, text_buffers, with_group

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: How far the share of equal minima may lie under the threshold; over five standard deviations at 128 minima.
MARGIN = 0.2
#: Buckets up to this size pair their members by a join, larger ones in blocks of CELL members a side.
SMALL, CELL = 64, 512
#: Up to so many ids (counted) are broadcast to pick out their texts; beyond, texts are shuffled to them.
MOST_SENT = 200_000

_RNG = np.random.Generator(np.random.PCG64(20))
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_C = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the rows, and each row's offsets."""
    w = Words(data, offsets, SPACE)
    h = w.hashes()
    n = w.count
    if not len(h):
        return h, np.zeros(w.n_rows + 1, np.int64)
    acc = mix(h + _STEP)
    full = acc.copy()
    for j in range(1, k):
        if len(h) > j:
            acc[:-j] = mix(acc[:-j] * _STEP + h[j:])
    place = np.arange(len(h)) - w.first[:-1][w.row]
    keep = place + k <= n[w.row]
    short = np.flatnonzero((n > 0) & (n < k))  # whole sequence as one
    rows, out = w.row[keep], acc[keep]
    if len(short):
        one = []
        for r in short:
            v = full[w.first[r]]
            for x in h[w.first[r] + 1 : w.first[r + 1]]:
                v = mix((np.asarray([v]) * _STEP + x))[0]
            one.append(mix(np.asarray([v]) + np.uint64(n[r]))[0])
        rows, out = np.concatenate([rows, short]), np.concatenate([out, np.array(one, np.uint64)])
    v, _, at = distinct_per_row(rows, out, w.n_rows)
    return v, at


def minima(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """HASHES minima (upper 32 bits of a multiply-add hash) for each row; rows without shingles get the largest value."""
    n = len(at) - 1
    out = np.full((HASHES, n), 0xFFFFFFFF, np.uint32)
    i = 0
    while i < n:  # some rows at a time, so that their hashes stay in cache
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + 30_000, "right")) - 1))
        part = v[at[i] : at[j]]
        full = np.flatnonzero(np.diff(at[i : j + 1])) + i
        if len(full):
            starts = at[full] - at[i]
            buf = np.empty(len(part), np.uint64)
            for k in range(HASHES):
                np.multiply(part, _A[k], out=buf)
                np.add(buf, _C[k], out=buf)
                out[k, full] = np.minimum.reduceat(buf, starts) >> np.uint64(32)
        i = j
    return out.T


def band_keys(m: np.ndarray) -> np.ndarray:
    out = np.empty((len(m), BANDS), np.uint64)
    for b in range(BANDS):
        acc = np.full(len(m), b + 1, np.uint64)
        for r in range(ROWS):
            acc = mix(acc * _STEP + m[:, b * ROWS + r])
        out[:, b] = acc
    return out.view(np.int64)


def _class(v: np.ndarray, at: np.ndarray, r: int) -> bytes:
    return hashlib.blake2b(v[at[r] : at[r + 1]].tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, k: int, text: str, key: str) -> DataFrame:
    """(id, n, class, bands, sig) of every row. class is null where a row is linked with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column("text"))
            ids = b.column("id")
            for i, j in slices(off):
                v, at = shingle_sets(data, off[i : j + 1], k)
                n = np.diff(at)
                m = minima(v, at)
                known = np.asarray(ids.slice(i, j - i).is_valid())
                linked = (n > 0) & known
                cls = [_class(v, at, r) if linked[r] else None for r in range(j - i)]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(band_keys(m).reshape(-1)))
                sig = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES), j - i, [None, pa.py_buffer(m.astype(np.uint8).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n), pa.array(cls, pa.binary()), bands, sig], ["id", "n", "class", "bands", "sig"])

    return docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(lean(run), f"id {dict(docs.dtypes)[key]}, n long, class binary, bands array<long>, sig binary")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int, text: str, key: str) -> DataFrame:
    """(id, set) of the wanted vertices: the sorted distinct shingle hashes as bytes, from the text of the class's smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off):
                v, at = shingle_sets(data, off[i : j + 1], k)
                own = b.column("class").slice(i, j - i).to_pylist()
                ok = [r for r in range(j - i) if _class(v, at, r) == own[r]]  # an id may have rows of other classes
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i).take(pa.array(ok, pa.int64())), pa.array([v[at[r] : at[r + 1]].tobytes() for r in ok], pa.binary())], ["id", "set"])

    few = materialize(classes.join(wanted, classes["vertex"] == wanted["id"]).select(F.col("least").alias("_key"), F.col("vertex").alias("id"), "class"), "wanted")
    sent = F.broadcast(few) if few.count() <= MOST_SENT else few
    some = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text")).join(sent, "_key").select("id", "class", "text")
    out = materialize(some.mapInArrow(lean(run), "id long, set binary").dropDuplicates(["id"]), "sets")
    discard(few)
    return out


def _with_both(edges: DataFrame, what: DataFrame, col: str) -> DataFrame:
    """edges with what is known of both ends; b, which may be a hub of many, is spread."""
    a = what.select(F.col("id").alias("a"), F.col(col).alias("sa"))
    b = what.select(F.col("id").alias("b"), F.col(col).alias("sb"))
    return join_spread(edges, b, "b", "a").join(a, "a").select("a", "b", "sa", "sb")


def _likely(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            m = [np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sa", "sb")]
            ok = (m[0] == m[1]).mean(axis=1) >= least - MARGIN
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(ok))

    return materialize(_with_both(pairs, sigs, "sig").mapInArrow(lean(near), "a long, b long"), "likely")


def _confirmed(likely: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """The pairs (a, b) whose sets have of * intersection >= least * union."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = []
            for p, q in zip(x.column("sa"), x.column("sb"), strict=True):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (p, q))
                both = 0
                if of * min(len(u), len(v)) >= least * max(len(u), len(v)):
                    w = np.sort(np.concatenate([u, v]), kind="stable")
                    both = int((w[1:] == w[:-1]).sum())
                ok.append(of * both >= least * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return materialize(_with_both(likely, sets, "set").mapInArrow(lean(same), "a long, b long"), "links")


def _vertices(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of edges (a, b) but the smallest of a component; component is that smallest id.

    Alternates large-star and small-star until nothing changes, writing each round to the shared folder."""

    def large_star(e: DataFrame) -> DataFrame:
        sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = with_group(sym, "u", "v", m=("min", "v"))
        return least.filter("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = with_group(down, "u", "v", m=("min", "v"))
        return least.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b")).distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    e = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        large = materialize(large_star(e), "large-star")
        nxt = materialize(small_star(large), "star")
        discard(large)
        now = state(nxt)
        discard(e)
        if now == before or not now[0]:
            return nxt.select(F.col("a").alias("id"), F.col("b").alias("component"))
        e, before = nxt, now


def _blocks(members: DataFrame, group: str) -> DataFrame:
    """Rows (group, i, j, own, rep, ...) so that any two members of a group meet in one block (i, j) of at most two cells."""
    cells = F.ceil(F.col("size") / CELL).cast("int")
    own = F.pmod(F.xxhash64("rep"), cells).cast("int")
    out = members.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), cells - 1)))
    return out.withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with")).drop("with", "size")


def _mixed(members: DataFrame, comps: DataFrame, group: str) -> DataFrame:
    """(group, rep, component, size) of the groups whose members are in several components."""
    m = members.select(group, "rep").join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    m = materialize(m, "with-component")
    return with_group(m, group, "rep", "lo <> hi", lo=("min", "component"), hi=("max", "component"), size=("count", "rep")).drop("lo", "hi")


def _family_links(families: DataFrame, comps: DataFrame, sigs: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """Links (a, b) between components within families: of each block as many as join components, all being confirmed."""
    full = sigs.join(sets, "id").withColumnRenamed("id", "rep")
    blocks = _blocks(_mixed(families, comps, "family"), "family").join(full, "rep")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(-1, HASHES)
        held = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        size = np.array([len(x) for x in held])
        rep, root = pdf["rep"].to_numpy(), pdf["component"].to_numpy().copy()
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        left, right = np.flatnonzero(pdf["own"] == i), np.flatnonzero(pdf["own"] == j)
        found = []
        for x in left:
            y = right if i != j else right[right > x]
            y = y[root[y] != root[x]]
            y = y[of * np.minimum(size[y], size[x]) >= least * np.maximum(size[y], size[x])]
            y = y[(sig[y] == sig[x]).mean(axis=1) >= least / of - MARGIN]
            if not len(y):
                continue
            every = np.concatenate([held[q] for q in y])
            at = np.minimum(np.searchsorted(held[x], every), size[x] - 1)
            both = np.add.reduceat(held[x][at] == every, np.concatenate([[0], np.cumsum(size[y])[:-1]]))
            for q in y[of * both >= least * (size[x] + size[y] - both)]:
                if root[q] != root[x]:
                    found.append((rep[x], rep[q]))
                    root[root == root[q]] = root[x]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return blocks.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def _bucket_pairs(members: DataFrame, families: DataFrame, comps: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of a bucket's members that are in different components and in no family together."""
    own = families.groupBy("rep").agg(F.collect_set("family").alias("families"))  # hubs of one's buckets, so at most BANDS
    m = _mixed(members.select("bucket", "rep"), comps, "bucket").join(own, "rep", "left")
    m = materialize(m.withColumn("families", F.coalesce("families", F.array().cast("array<long>"))), "mixed")
    small = m.filter(F.col("size") <= SMALL)
    other = small.select("bucket", F.col("rep").alias("b"), F.col("component").alias("other"), F.col("families").alias("of_b"))
    apart = (F.col("a") < F.col("b")) & (F.col("component") != F.col("other")) & ~F.arrays_overlap("families", "of_b")
    pairs = small.withColumnRenamed("rep", "a").join(other, "bucket").filter(apart).select("a", "b")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(-1, HASHES)
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        left, right = np.flatnonzero(pdf["own"] == i), np.flatnonzero(pdf["own"] == j)
        rep, comp, fams = pdf["rep"].to_numpy(), pdf["component"].to_numpy(), [set(f) for f in pdf["families"]]
        found = set()
        for x in left:
            ok = ((sig[right] == sig[x]).mean(axis=1) >= least - MARGIN) & (comp[right] != comp[x])
            found.update((min(rep[x], rep[r]), max(rep[x], rep[r])) for r in right[ok] if fams[x].isdisjoint(fams[r]))
        return pd.DataFrame(sorted(found), columns=["a", "b"]).astype("int64")

    big = _blocks(m.filter(F.col("size") > SMALL), "bucket").join(sigs.withColumnRenamed("id", "rep"), "rep")
    return pairs.union(big.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")).distinct()


def _same_id(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of an id that has rows of several."""
    several = linked.groupBy("id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("id")
    several = materialize(several, "repeated")
    if several.isEmpty():
        return several.sparkSession.createDataFrame([], "a long, b long")
    of = materialize(linked.select("id", "class").join(several, "id", "left_semi").distinct().join(classes.select("class", "vertex"), "class").select("id", "vertex"), "repeated")
    return with_group(of, "id", "vertex", m=("min", "vertex")).filter("vertex <> m").select(F.col("vertex").alias("a"), F.col("m").alias("b"))


def near_duplicates(docs: DataFrame, k: int = 5, least: int = 80, of: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; linked where of * intersection >= least * union of k-word shingles."""
    all_rows = materialize(signatures(docs, k, text, key), "signatures")
    linked = all_rows.filter(F.col("class").isNotNull())
    classes = linked.groupBy("class").agg(F.min("id").alias("least"))
    classes = materialize(classes.withColumn("vertex", F.monotonically_increasing_id()), "classes")
    first = classes.select("class", F.col("least").alias("id"), "vertex")
    reps = materialize(linked.join(first, ["class", "id"]).select(F.col("vertex").alias("id"), "bands", "sig").dropDuplicates(["id"]), "reps")
    sigs = reps.select("id", "sig")
    same_id = materialize(_same_id(linked, classes), "same-id")

    rows = reps.select(F.col("id").alias("rep"), F.explode("bands").alias("bucket"))
    members = materialize(with_group(rows, "bucket", "rep", "size > 1", size=("count", "rep")), "members")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "rep").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("hub")).select("bucket", (-F.col("hub.rep")).alias("hub"))
    to_hub = join_spread(members.select("bucket", "rep"), hubs, "bucket", "rep").filter("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    near_hub = _likely(materialize(to_hub, "to-hub"), sigs, least / of)
    sets = _sets(docs, classes, _vertices(near_hub), k, text, key)
    links = _confirmed(near_hub, sets, least, of).union(same_id)
    comps = components(links)
    families = materialize(near_hub.select(F.col("b").alias("family"), F.col("a").alias("rep")).union(near_hub.select("b", "b")).distinct(), "families")
    more = materialize(_family_links(families, comps, sigs, sets, least, of), "family-links")
    discard(sets)
    if not more.isEmpty():
        links = links.union(more)
        comps = components(links)
    pairs = _likely(materialize(_bucket_pairs(members, families, comps, sigs, least / of), "pairs"), sigs, least / of)
    if not pairs.isEmpty():
        sets = _sets(docs, classes, _vertices(pairs), k, text, key)
        more = _confirmed(pairs, sets, least, of)
        discard(sets)
        if not more.isEmpty():
            comps = components(links.union(more))
    # a component's smallest id, for each class
    of_class = classes.join(comps.withColumnRenamed("id", "vertex"), "vertex", "left").select("class", "least", F.coalesce("component", "vertex").alias("component"))
    of_class = materialize(of_class, "of-class")
    of_class = materialize(with_group(of_class, "component", "class", component_id=("min", "least")).select("class", "component_id"), "component-ids")
    for used in (reps, members, near_hub, families):
        discard(used)
    out = join_spread(all_rows.select("id", "n", "class"), of_class, "class", "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, k: int = 5, least: int = 80, of: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one document of each class of near copies, of rows equal in id and text one, and every row that is linked with nothing.

    An id goes only if all its rows do. The ids that go are broadcast up to MOST_SENT of them (counted)."""
    found = near_duplicates(docs, k, least, of, text, key)
    per_id = materialize(found.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).filter("not kept or rows > 1"), "decided")
    sent = F.broadcast if per_id.count() <= MOST_SENT else lambda x: x
    gone, again = per_id.filter("not kept").select(key), per_id.filter("kept").select(key)
    out = docs.join(sent(gone), key, "left_anti")
    if not again.isEmpty():
        out = out.join(sent(again), key, "left_anti").unionByName(docs.join(sent(again), key, "left_semi").dropDuplicates([key, text]))
    return out.select(*docs.columns)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies over 2-word shingles, by its smallest doc_id."""
    return near_duplicates(table(spark, sf_dir, "documents", spread=True), k=2)
