"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, where telling terms weigh more.

Terms are words and their beginnings of 5 and 7 bytes (whole letters only). The vocabulary is every term of the examples;
terms that no example holds are not part of a text's vector. Examples are a sample of labelled rows of at most MOST_EXAMPLES
(a parameter); document frequencies come from all documents. A term's weight is its idf, times 1 + sqrt(G) where the term leans
to positive examples: G is the likelihood ratio statistic of its frequencies in positive and other examples, each distinct
text counted once.

The examples' vectors form a block-max inverted index, which is searched for a group of texts at a time (blockmax.py), so
the k nearest are exact. Only examples of a positive cosine are near. Votes are weighted by distance and calibrated by
isotonic regression on leave-one-out votes of the examples (without the terms that only the example left out holds).

Cases: null and empty texts, and others without a term of some example, get the share of positive labels; a null id is
scored (and counts as held out); of rows that repeat an id, examples take the smallest text, and of its labels the largest;
of equally near examples the smaller id counts; a very long text is a slice of its own; without any usable label every score
is 0; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.blockmax import GROUP, Lists, best_rows, one_thread
from vacatia.llm.common import NON_WORD, Pieces, Words, discard, distinct_per_row, hash_spans, lean, materialize, share, shared, slices, table, text_buffers, trim

PREFIXES = (5, 7)
#: Bound of the sample of labelled rows, by the order of a hash of their ids.
MOST_EXAMPLES = 8192
NEIGHBOURS = 25
#: A list of more than one example in DENSE may be dense (blockmax.py).
DENSE = 12
BUCKET_BITS = 20
THRESHOLD = 0.3


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and hash of every term occurrence."""
    w = Words(data, offsets, NON_WORD, lower=False)
    rows, hashes = [w.row], [w.hashes()]
    size = w.end - w.start
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        end = w.start[long] + n
        for _ in range(3):  # back to where a letter begins
            end = end - ((w.data[end] & 0xC0) == 0x80)
        rows += [w.row[size == n], w.row[long]]
        hashes += [hashes[0][size == n] ^ np.uint64(n), hash_spans(w.data, w.start[long], end) ^ np.uint64(n)]
    return np.concatenate(rows), np.concatenate(hashes), w.n_rows


def _lowered(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(pc.utf8_lower(col))


def _known(rows: np.ndarray, h: np.ndarray, vocabulary: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places in the (sorted) vocabulary of the occurrences of its terms."""
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    at, end = buckets[bucket], buckets[bucket + 1]
    place = np.full(len(h), -1, np.int32)
    left = np.flatnonzero(at < end)
    while len(left):
        same = vocabulary[at[left]] == h[left]
        place[left[same]] = at[left[same]]
        left = left[~same]
        at[left] += 1
        left = left[at[left] < end[left]]
    hit = place >= 0
    return rows[hit], place[hit].astype(np.int64)


def _buckets(vocabulary: np.ndarray) -> np.ndarray:
    """Where the terms of each value of the first BUCKET_BITS bits begin."""
    size = np.bincount((vocabulary >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int32)


class Index:
    """The examples' vectors as posting lists over their places in the order of ids, and what a vote needs."""

    def __init__(self, spark: SparkSession, ids: np.ndarray, labels: np.ndarray, words: str, arrays: dict[str, np.ndarray | Pieces]):
        """words: the shared file of the vocabulary and its buckets; arrays: idf (with the factor of telling terms), held (examples of
        a term), and the lists as Lists.laid_out() gives them."""
        self.ids, self.labels, self.prior = ids, labels, float(labels.mean())
        self.steps = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        self.words, self.file = words, share(spark, "examples", arrays)
        self._ready: tuple[dict[str, np.ndarray], Lists] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def ready(self) -> tuple[dict[str, np.ndarray], Lists]:
        """The mapped arrays and the lists, which are mapped too, so that a worker holds none of them; once a process."""
        if self._ready is None:
            one_thread()
            x = {k: np.asarray(v) for f in (self.words, self.file) for k, v in shared(f).items()}
            self._ready = x, Lists.mapped(len(self.ids), x)
        return self._ready

    def nearest(self, v: Vectors, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples to each row of v, -1 where there are fewer; own: an example that is left out."""
        n, k = len(v.first) - 1, min(k, len(self.ids))
        who, cosine = np.full((n, k), -1), np.full((n, k), -1.0)
        _, lists = self.ready()
        more = k if own is None else min(k + 1, len(self.ids))
        for a in range(0, n, GROUP):
            z = min(a + GROUP, n)
            part = slice(v.first[a], v.first[z])
            row, place, score = best_rows(lists, v.first[a : z + 1] - v.first[a], v.term[part], v.weight[part], np.full(z - a, 1e-8), np.ones(z - a, bool), np.ones(len(self.ids), bool), more)
            score = np.round(score, 8)
            ok = score > 0
            if own is not None:
                ok &= place != own[a + row]
            row, place, score = row[ok], place[ok], score[ok]
            by = np.lexsort((place, -score, row))
            row, place, score = row[by], place[by], score[by]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            top = rank < k
            who[a + row[top], rank[top]], cosine[a + row[top], rank[top]] = place[top], score[top]
        return who, cosine

    def vote(self, who: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        w = np.where(who >= 0, 1 / (1.02 - np.clip(cosine, 0, 1)), 0)
        return (w * self.labels[who]).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-12)

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return np.clip(0.98 * np.interp(votes, *self.steps) + 0.02 * votes, 0, 1)  # the vote itself orders what is level

    def vectors_of(self, data: np.ndarray, offsets: np.ndarray, by_several: bool = False) -> Vectors:
        """Of a slice of texts; by_several: only of terms that several examples hold."""
        x, _ = self.ready()
        rows, h, n = _terms(data, offsets)
        row, term, tf = counted(*_known(rows, h, x["vocabulary"], x["buckets"]), len(x["vocabulary"]))
        if by_several:
            some = x["held"][term] > 1
            row, term, tf = row[some], term[some], tf[some]
        return vectors(row, term, (1 + np.log(tf)) * x["idf"][term], n)


def counted(rows: np.ndarray, at: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with their counts."""
    key = np.sort(rows * n_terms + at)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return *np.divmod(key[new], n_terms), np.diff(new, append=len(key))


@dataclass
class Vectors:
    """Sparse rows: offsets of each row, terms (places in the vocabulary) and weights."""

    first: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def vectors(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n_rows: int) -> Vectors:
    """Unit vectors, from entries in the order of the rows; rows without a known term stay empty."""
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=n_rows))
    return Vectors(np.searchsorted(row, np.arange(n_rows + 1)), term, weight / norm[row])


def pieces(n: int, most: int = 1 << 19) -> Iterator[slice]:
    """0 to n in ranges, so that what is computed of postings is never as long as they are."""
    return (slice(i, min(i + most, n)) for i in range(0, n, most))


def telling(row: np.ndarray, term: np.ndarray, n_terms: int, y: np.ndarray, once: np.ndarray) -> np.ndarray:
    """1 + sqrt(G) of every term that leans to positive examples, else 1. once: the examples that count."""
    counts = np.zeros(len(y), bool)
    counts[once] = True
    n, a = np.zeros(n_terms), np.zeros(n_terms)
    for s in pieces(len(row)):
        some = counts[row[s]]
        t = term[s][some]
        n += np.bincount(t, minlength=n_terms)
        a += np.bincount(t, weights=y[row[s][some]], minlength=n_terms)
    p, q = y[once].sum(), len(once) - y[once].sum()
    part = lambda x, e: x * np.log(np.where(x > 0, x, 1) / np.where(x > 0, e, 1))
    e = n * (p / (p + q))
    g = 2 * (part(a, e) + part(n - a, n - e) + part(p - a, p - e) + part(q - (n - a), q - (n - e)))
    return np.where(a * q > (n - a) * p, 1 + np.sqrt(np.maximum(g, 0)), 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the pools' mean x and (smoothed) mean y, for linear interpolation."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum x, sum y, n
    for a, b in zip(x[order], y[order], strict=True):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            top = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], top, strict=True)]
    xs = np.array([p[0] / p[2] for p in pools])
    ys = np.array([(p[1] + 0.5 * y.mean()) / (p[2] + 0.5) for p in pools])
    ys = np.maximum.accumulate(ys)
    return np.concatenate([[0.0], xs, [1.0]]), np.concatenate([ys[:1] * 0.5, ys, [max(ys[-1], 0.999)]])


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text; null ids count as held out, so that nothing is learnt from them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id", most: int = MOST_EXAMPLES) -> Index | None:
    """The index of at most `most` labelled examples; None without any. labels must hold only rows to learn from."""
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("label"))
    sample = usable.orderBy(F.xxhash64(F.col(key), F.lit(8)), key).limit(most)
    # bounded: at most `most` rows of an id and a label
    examples = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key).groupBy(key, "label").agg(F.min("text").alias("text"))
    examples = materialize(examples.withColumn("digest", F.xxhash64("text")), "examples")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = _lowered(b.column("text"))
            for i, j in slices(off):
                h, tf, at = distinct_per_row(*_terms(data, off[i : j + 1]))
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x)) for x in (h.view(np.int64), tf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in (key, "label", "digest")), *lists], [key, "label", "digest", "terms", "tf"])

    kind = dict(examples.dtypes)[key]
    rows = examples.orderBy(key).mapInArrow(lean(terms_of), f"`{key}` {kind}, label int, digest long, terms array<long>, tf array<int>").toArrow()
    if not len(rows):
        return None
    ids, y = np.array(rows.column(key).to_pylist()), np.array(rows.column("label").to_pylist(), float)
    hashes, tf = (np.concatenate([np.asarray(c.flatten()) for c in rows.column(k).chunks]) for k in ("terms", "tf"))
    row = np.repeat(np.arange(len(ids), dtype=np.int32), np.asarray(pc.list_value_length(rows.column("terms"))))
    # each distinct text once, so that copies make no word telling
    once = np.unique(np.stack([np.asarray(rows.column("digest")), y.astype(np.int64)]), axis=1, return_index=True)[1]
    del rows
    pa.default_memory_pool().release_unused()
    hashes = hashes.view(np.uint64)
    vocabulary = np.sort(hashes)
    new = np.ones(len(vocabulary), bool)
    np.not_equal(vocabulary[1:], vocabulary[:-1], out=new[1:])
    vocabulary = vocabulary[new]
    if not len(vocabulary):
        return None
    term = np.empty(len(hashes), np.int32)
    for s in pieces(len(term)):
        term[s] = np.searchsorted(vocabulary, hashes[s])
    del hashes, new
    n_terms, words = len(vocabulary), share(docs.sparkSession, "vocabulary", {"vocabulary": vocabulary, "buckets": _buckets(vocabulary)})
    del vocabulary
    trim()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = (np.asarray(shared(words)[k]) for k in ("vocabulary", "buckets"))
        n, df = 0, np.zeros(n_terms, np.int64)
        for b in batches:
            n += b.num_rows
            data, off = _lowered(b.column("text"))
            for i, j in slices(off):
                rows, h, _ = _terms(data, off[i : j + 1])
                _, at, _ = counted(*_known(rows, h, vocabulary, known), n_terms)
                df += np.bincount(at, minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], held])), pa.array(np.concatenate([[n], df[held]]))], ["at", "n"])

    of = docs.select(F.col(text).alias("text")).mapInArrow(lean(frequencies), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(n_terms + 1)
    df[np.asarray(of.column("at")) + 1] = np.asarray(of.column("n"))
    del of
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1

    idf = idf * telling(row, term, n_terms, y, once)

    weight = np.empty(len(term))
    for s in pieces(len(term)):
        weight[s] = (1 + np.log(tf[s])) * idf[term[s]]
    del tf
    norm = np.zeros(len(ids))
    for s in pieces(len(term)):
        np.add.at(norm, row[s], weight[s] * weight[s])
    norm = np.sqrt(norm)
    for s in pieces(len(term)):
        weight[s] /= norm[row[s]]
    held = np.bincount(term, minlength=n_terms)
    by = np.argsort(term, kind="stable").astype(np.int32 if len(term) < 1 << 31 else np.int64)
    del term
    lists = Lists.laid_out(len(ids), np.concatenate([[0], np.cumsum(held)]), lambda post: (row[by[post]], weight[by[post]]), DENSE)
    arrays = {"idf": idf, "held": held.astype(np.int32)} | lists
    out = Index(docs.sparkSession, ids, y, words, arrays)
    del weight, by, row, arrays, lists, idf, held
    trim()
    place = {i: n for n, i in enumerate(ids.tolist())}
    sent = docs.sparkSession.sparkContext.broadcast(out)  # bounded by MOST_EXAMPLES

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for b in batches:
            data, off = _lowered(b.column("text"))
            for i, j in slices(off):
                own = b.column(key).slice(i, j - i)
                who, cosine = index.nearest(index.vectors_of(data, off[i : j + 1], by_several=True), NEIGHBOURS, np.searchsorted(index.ids, np.array(own.to_pylist())))
                seen = (who >= 0).any(axis=1)
                yield pa.RecordBatch.from_arrays([own.filter(pa.array(seen)), pa.array(index.vote(who, cosine)[seen])], [key, "vote"])

    votes = examples.select(key, "text").repartition(docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(lean(left_out), f"`{key}` {kind}, vote double").collect()
    sent.destroy()
    discard(examples)
    if votes:
        at = np.array([place[r[0]] for r in votes])
        by = np.argsort(at)
        out.steps = isotonic(np.array([r[1] for r in votes])[by], y[at[by]])
    return out


def _scored(index: Index, texts: pa.Array, evidence: bool) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """First row, scores and (if asked for) evidence of each slice of texts."""
    data, off = _lowered(texts)
    for i, j in slices(off, 1 << 19):
        who, cosine = index.nearest(index.vectors_of(data, off[i : j + 1]), NEIGHBOURS)
        seen = (who >= 0).any(axis=1)
        said = [""] * (j - i)
        if evidence:
            for r in np.flatnonzero(seen):
                said[r] = ",".join(f"{index.ids[e]}:{c:.4f}:{int(index.labels[e])}" for e, c in zip(who[r, :3], cosine[r, :3], strict=True) if e >= 0)
        yield i, np.where(seen, index.calibrated(index.vote(who, cosine)), index.prior), said


def score(docs: DataFrame, index: Index | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, evidence) of every row: evidence is the three nearest examples, as id:cosine:label."""
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, score double, evidence string"
    if index is None:
        return docs.select(key, F.lit(0.0).alias("score"), F.lit("").alias("evidence"))
    sent = docs.sparkSession.sparkContext.broadcast(index)  # bounded by MOST_EXAMPLES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, scores, evidence in _scored(sent.value, b.column("text"), True):
                yield pa.RecordBatch.from_arrays([b.column(key).slice(i, len(scores)), pa.array(scores), pa.array(evidence)], [key, "score", "evidence"])
            trim()

    return docs.select(key, F.col(text).alias("text")).mapInArrow(lean(run), schema)


def reject(docs: DataFrame, index: Index | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs without the rows that score the threshold or more, with all their columns."""
    if index is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, scores, _ in _scored(sent.value, b.column(text), False):
                yield b.slice(i, len(scores)).filter(pa.array(scores < threshold))
            trim()

    return docs.mapInArrow(lean(run), docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, learnt only from labels whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    out = held_out("doc_id", 4, 2)
    index = fit(docs, table(spark, sf_dir, "labels").filter(~out))
    return score(docs, index).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
