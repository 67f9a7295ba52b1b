"""Mixing sources to target weights by iterative proportional fitting.

A text's topic is the nearest of TOPICS centres, learnt by k-means from all texts: each is read once, what is left of it are the
counts of its hashed words (a table, a row for each slice of texts), which every round goes through. Sums are of whole numbers, so
that their order is nothing. Where the sampled rows need no text, their other columns lie in that table too.
Tokens are summed by cell (source, language, topic) over all documents. Raking scales the cells' token weights to the target shares of each
marginal in turn until all hold. A cell's documents are then kept with one probability: its raked weight times a scale,
at most 1, over its tokens, where the scale makes the expected tokens meet the budget; weight carries what the cap took
(raked share over expected share), so weighted totals still meet the targets. A document is kept if a hash of its id and
text, as a number from 0 to 1, lies under its probability: the same rows are kept at every run, and repeated rows alike.

Cells are raked on the driver up to MOST_CELLS of them (checked), and as a table beyond.

Where the targets can't all be met, raking stops after ROUNDS rounds, with a warning that says how far off it is.

Cases: null or empty source or language is the value "(none)"; null and empty texts have no tokens and the first topic, and
are kept with their cell's probability; a cell without any token gets the budget's share; a target value that no document has is dropped, and shares are normalised over the rest; values
without a target get none (probability 0); an empty table gives an empty result; extra columns pass through sample().
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BinaryType, StructType

from vacatia.llm.common import SPACE, Words, discard, distinct_per_row, lean, materialize, slices, table, text_buffers, trim

MOST_CELLS = 50_000
#: Share of all tokens that the sample aims at.
BUDGET = 0.5
#: Without given shares, a marginal's targets are its tokens to this power: under 1 lifts small values.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS, TOLERANCE = 200, 1e-9
#: Topics, places that words are hashed to, and the most rounds of k-means.
TOPICS, FEATURES, FITS = 8, 4096, 20
#: A language has a mean text of its own if one text in so many is in it; the others share one.
OWN_MEAN = 100
#: Sums over texts are of multiples of this.
UNIT = 2.0**-30
SEED = 6
#: Slices of texts (1 MB each, or one text) of a file of the table of counts, and hashed words that are looked at together.
SLICES_A_FILE, AT_ONCE = 64, 1 << 14
#: Counts from here on take eight bytes.
OFTEN = 255
LOGS = 1 + np.log(np.maximum(np.arange(OFTEN + 1), 1))


@dataclass
class Topics:
    """Centres of topics over hashed words, and what a text's language takes off: its mean text's likeness to each centre."""

    idf: np.ndarray
    centres: np.ndarray  # FEATURES x topics
    taken: dict[str | None, np.ndarray]  # None: any language without a mean of its own

    def names(self) -> list[str]:
        return [f"topic{t}" for t in range(self.centres.shape[1])]


def features(w: Words) -> np.ndarray:
    return (w.hashes() % np.uint64(FEATURES)).astype(np.int64)


def counted(docs: DataFrame, text: str, lang: str, **kept: Column) -> DataFrame:
    """A row for each slice of texts. Of its texts: _source, _lang and the columns kept (arrays), n (words) and size (hashed words,
    8 bytes each). Of all hashed words in turn: at (places, 2 bytes each) and tf (how often, a byte each; OFTEN: the next of often,
    8 bytes each)."""
    rows = docs.select(F.col(text).alias("text"), (none("source") if "source" in docs.columns else F.lit("")).alias("_source"), none(lang).alias("_lang"), *[c.alias(k) for k, c in kept.items()])
    packed = ("n", "size", "at", "tf", "often")
    schema = StructType()
    for f in rows.schema.fields[1:]:
        schema = schema.add(f.name, ArrayType(f.dataType))
    for k in packed:
        schema = schema.add(k, BinaryType())
    lists = schema.names[: -len(packed)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off):
                w = Words(data, off[i : j + 1], SPACE)
                at, tf, first = distinct_per_row(w.row, features(w).astype(np.uint64), w.n_rows)
                values = (w.count.astype("<i8"), np.diff(first).astype("<i8"), at.astype("<u2"), np.minimum(tf, OFTEN).astype(np.uint8), tf[tf >= OFTEN].astype("<i8"))
                listed = [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), b.column(c).slice(i, j - i)) for c in lists]
                yield pa.RecordBatch.from_arrays([*listed, *(pa.array([x.tobytes()], pa.binary()) for x in values)], schema.names)

    return rows.mapInArrow(lean(run), schema)


def packed(b: pa.RecordBatch, x: int, name: str, kind: type | str) -> np.ndarray:
    return np.frombuffer(b.column(name)[x].as_buffer(), kind)


def unpacked(b: pa.RecordBatch, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """at, counts and offsets of the texts of row x of counted()."""
    tf = packed(b, x, "tf", np.uint8).astype(np.int64)
    tf[tf == OFTEN] = packed(b, x, "often", "<i8")
    return packed(b, x, "at", "<u2").astype(np.int64), tf, np.concatenate([[0], np.cumsum(packed(b, x, "size", "<i8"))])


def sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of x from first[i] to first[i + 1]."""
    out = np.zeros(len(first) - 1)
    some = first[:-1] < first[1:]
    if some.any():
        out[some] = np.add.reduceat(x, first[:-1][some])
    return out


def products(centres: np.ndarray, at: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """rows x centres, from sparse rows and centres x FEATURES. In parts that stay in cache."""
    centres, out = np.ascontiguousarray(centres), np.empty((len(first) - 1, len(centres)))
    for i, j in slices(first, AT_ONCE):
        part = slice(first[i], first[j])
        a, v, of = at[part], w[part], first[i : j + 1] - first[i]
        held = np.empty(len(a))
        for k, c in enumerate(centres):
            np.take(c, a, out=held, mode="clip")
            held *= v
            out[i:j, k] = sums(held, of)
    return out


def logs(tf: np.ndarray) -> np.ndarray:
    """1 + log(tf)."""
    out = np.take(LOGS, np.minimum(tf, OFTEN))
    out[tf > OFTEN] = 1 + np.log(tf[tf > OFTEN])
    return out


def unit(idf: np.ndarray, at: np.ndarray, tf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Weights of the words of rows, of length 1 each."""
    weight = logs(tf) * idf[at]
    return weight / np.repeat(np.maximum(np.sqrt(sums(weight * weight, first)), 1e-12), np.diff(first))


def nearest(topics: Topics, at: np.ndarray, tf: np.ndarray, first: np.ndarray, langs: list[str | None]) -> np.ndarray:
    """Topics of rows; the first of a row without words."""
    if not len(langs):
        return np.zeros(0, np.int64)
    near = products(topics.centres.T, at, unit(topics.idf, at, tf, first), first)
    taken = np.array([topics.taken.get(v, topics.taken[None]) for v in langs]).reshape(len(langs), -1)
    return np.where(np.diff(first) > 0, np.round(near - taken, 9).argmax(axis=1), 0)


def fit_topics(docs: DataFrame, text: str, key: str, lang: str) -> Topics:
    """Topics of all texts. The same for the same rows, in any order; key is not read."""
    rows = materialize(counted(docs, text, lang), "counted", maxRecordsPerFile=SLICES_A_FILE)
    out = learnt(rows)
    discard(rows)
    return out


def learnt(table: DataFrame) -> Topics:
    """Spherical k-means over all texts of counted() that have words: TF-IDF vectors, each less the mean vector of its
    language, so that topics are not languages, and of length 1 (0 where it is that mean)."""
    sc = table.sparkSession.sparkContext

    def of_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                got = b.column("_lang")[x].values.filter(pa.array(packed(b, x, "n", "<i8") > 0)).value_counts()
                yield pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], ["_lang", "n"])

    one = table.select("_lang", "n").mapInArrow(lean(of_languages), "_lang string, n long").groupBy("_lang").agg(F.sum("n").alias("n"))
    one = materialize(one, "languages")
    n = one.agg(F.sum("n")).first()[0]
    langs = sorted(r["_lang"] for r in one.filter(F.col("n") * OWN_MEAN >= (n or 0)).collect()) if n else []  # OWN_MEAN at most
    discard(one)
    if not n:
        return Topics(np.ones(FEATURES), np.zeros((FEATURES, 1)), {None: np.zeros(1)})
    code = {v: i for i, v in enumerate(langs)}
    width = FEATURES + len(langs) + 1

    def total(rows: DataFrame, groups: int, of: Callable[[pa.RecordBatch, int], list[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
        """groups x FEATURES and groups x languages: sums of what `of` gives for each row, whole numbers."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros(groups * width, np.int64)
            for b in batches:
                for x in range(b.num_rows):
                    for place, value in of(b, x):
                        acc += np.bincount(place, weights=value, minlength=len(acc)).astype(np.int64)
            held = np.flatnonzero(acc)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(acc[held])], ["place", "value"])

        got = rows.mapInArrow(lean(run), "place long, value long").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(groups * width)
        out[np.asarray(got.column("place"))] = np.asarray(got.column("value"))
        return out.reshape(groups, -1)

    def codes(b: pa.RecordBatch, x: int) -> np.ndarray:
        own = b.column("_lang")[x].values.dictionary_encode()
        return np.array([code.get(v, len(langs)) for v in own.dictionary.to_pylist()], np.int64)[np.asarray(own.indices)]

    def worded(b: pa.RecordBatch, x: int) -> tuple[np.ndarray, ...]:
        """Which texts of row x have words; of those: language, at, counts and offsets."""
        at, tf, first = unpacked(b, x)
        some = first[:-1] < first[1:]
        return some, codes(b, x)[some], at, tf, np.concatenate([[0], first[1:][some]])

    def frequencies(b: pa.RecordBatch, x: int) -> list[tuple[np.ndarray, np.ndarray]]:
        at = packed(b, x, "at", "<u2").astype(np.int64)
        return [(at, np.ones(len(at)))]

    idf = np.log(n / np.maximum(total(table.select("at"), 1, frequencies)[0, :FEATURES], 1)) + 1
    words = table.select("_lang", "size", "at", "tf", "often")

    def by_language(b: pa.RecordBatch, x: int) -> list[tuple[np.ndarray, np.ndarray]]:
        _, own, at, tf, first = worded(b, x)
        w = unit(idf, at, tf, first)
        return [(np.repeat(own * width, np.diff(first)) + at, np.rint(w / UNIT)), (own * width + FEATURES, np.ones(len(own)))]

    got = total(words, len(langs) + 1, by_language)
    means = got[:, :FEATURES] * UNIT / np.maximum(got[:, FEATURES, None], 1)
    sent = sc.broadcast((idf, means, (means * means).sum(axis=1)))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What every round needs of each text with words: its language, 1 / (length of its vector) and 1 / (length without the mean)."""
        idf, means, size = sent.value
        for b in batches:
            for x in range(b.num_rows):
                some, own, at, tf, first = worded(b, x)
                weight = logs(tf) * idf[at]
                length = np.maximum(np.sqrt(sums(weight * weight, first)), 1e-12)
                left = 1 + size[own] - 2 * sums(means.ravel()[np.repeat(own * FEATURES, np.diff(first)) + at] * weight, first) / length
                inverse = np.where(left > 1e-6, 1 / np.sqrt(np.maximum(left, 1e-6)), 0.0)
                values = (own, 1 / length, inverse, np.diff(first))
                names = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), b.column("_lang")[x].values.filter(pa.array(some)))
                kept = [b.column(c).slice(x, 1) for c in ("at", "tf", "often")]
                yield pa.RecordBatch.from_arrays([names, *kept, *(pa.array([v.tobytes()], pa.binary()) for v in values)], ["_lang", "at", "tf", "often", "own", "scale", "inverse", "size"])

    ready = materialize(words.mapInArrow(lean(scaled), "_lang array<string>, at binary, tf binary, often binary, own binary, scale binary, inverse binary, size binary"), "scaled", maxRecordsPerFile=SLICES_A_FILE)

    def vectors(b: pa.RecordBatch, x: int, centres: np.ndarray) -> tuple[np.ndarray, ...]:
        """at and weights (of length 1 after times scale), first, language, scale, 1 / (length without the mean), likeness to centres."""
        idf, means, _ = sent.value
        at, tf, first = unpacked(b, x)
        own, scale, inverse = packed(b, x, "own", np.int64), packed(b, x, "scale", float), packed(b, x, "inverse", float)
        w = logs(tf) * idf[at]
        near = products(centres, at, w, first) * scale[:, None]
        return at, w, first, own, scale, inverse, np.round((near - (means @ centres.T)[own]) * inverse[:, None], 9)

    def least_like(centres: np.ndarray) -> np.ndarray:
        """The text that is least like all centres (of equal ones the first by its language and words)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for b in batches:
                for x in range(b.num_rows):
                    score = vectors(b, x, centres)[-1].max(axis=1) if len(centres) else np.zeros(len(packed(b, x, "own", np.int64)))
                    if not len(score) or (best is not None and score.min() > best[0]):
                        continue
                    few = np.flatnonzero(score == score.min())
                    names, least = b.column("_lang")[x].values.take(pa.array(few)).to_pylist(), float(score.min())
                    if best is not None and (least, min(names)) > best[:2]:
                        continue
                    at, tf, first = unpacked(b, x)
                    for i, name in zip(few.tolist(), names, strict=True):
                        if best is None or (least, name) <= best[:2]:
                            part = slice(first[i], first[i + 1])
                            own = (least, name, at[part].astype("<u2").tobytes(), tf[part].astype("<i8").tobytes())
                            best = own if best is None else min(best, own)
            if best:
                yield pa.RecordBatch.from_pylist([dict(zip(("score", "_lang", "at", "tf"), best, strict=True))], schema)

        schema = pa.schema([("score", pa.float64()), ("_lang", pa.string()), ("at", pa.binary()), ("tf", pa.binary())])
        r = ready.mapInArrow(lean(run), "score double, _lang string, at binary, tf binary").orderBy("score", "_lang", "at", "tf").first()
        at, tf = np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["tf"], "<i8")
        y = -means[code.get(r["_lang"], len(langs))]
        y[at] += unit(idf, at, tf, np.array([0, len(at)]))
        size = np.linalg.norm(y)
        return y / size if size > 1e-3 else np.zeros(FEATURES)

    centres = np.zeros((0, FEATURES))
    while len(centres) < min(TOPICS, n):  # the first, then again and again the text least like all centres so far
        centres = np.concatenate([centres, least_like(centres)[None]])
    rounds = ready.drop("_lang")
    for _ in range(FITS):

        def of_topics(b: pa.RecordBatch, x: int, centres: np.ndarray = centres) -> list[tuple[np.ndarray, np.ndarray]]:
            at, w, first, own, scale, inverse, like = vectors(b, x, centres)
            topic, size = like.argmax(axis=1) * width, np.diff(first)
            w *= np.repeat(scale * inverse / UNIT, size)
            at += np.repeat(topic, size)
            return [(at, np.rint(w, out=w)), (topic + FEATURES + own, np.rint(inverse / UNIT))]

        got = total(rounds, len(centres), of_topics) * UNIT
        moved = got[:, :FEATURES] - got[:, FEATURES:] @ means
        size = np.linalg.norm(moved, axis=1, keepdims=True)
        moved = np.where(size > 1e-9, moved / np.maximum(size, 1e-9), centres)  # without a text it stays
        if np.allclose(moved, centres):
            break
        centres = moved
    sent.destroy()
    discard(ready)
    return Topics(idf, np.ascontiguousarray(centres.T), {v: centres @ means[i] for v, i in code.items()} | {None: centres @ means[-1]})


def described(topics: Topics) -> Callable[[Column, Column], Column]:
    """struct(n: words between ASCII white space, topic) of a text and its language, in Arrow batches."""

    @F.arrow_udf("struct<n:long,topic:string>")
    def of(text: pa.Array, lang: pa.Array) -> pa.Array:
        n, topic = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        data, off = text_buffers(text)
        langs = lang.to_pylist()
        for i, j in slices(off):
            w = Words(data, off[i : j + 1], SPACE)
            at, tf, first = distinct_per_row(w.row, features(w).astype(np.uint64), w.n_rows)
            n[i:j], topic[i:j] = w.count, nearest(topics, at.astype(np.int64), tf, first, langs[i:j])
        trim()
        return pa.StructArray.from_arrays([pa.array(n), pa.array(topics.names()).take(pa.array(topic))], ["n", "topic"])

    return of


def _placed(rows: DataFrame, topics: Topics, *kept: str) -> DataFrame:
    """(_source, _lang, the columns kept, _n: words, _topic) of every text of counted()."""
    lists = ["_source", "_lang", *kept]
    schema = StructType()
    for c in lists:
        schema = schema.add(c, rows.schema[c].dataType.elementType)
    schema = schema.add("_n", "long").add("_topic", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                values = [b.column(c)[x].values for c in lists]
                topic = nearest(topics, *unpacked(b, x), values[1].to_pylist())
                yield pa.RecordBatch.from_arrays([*values, pa.array(packed(b, x, "n", "<i8")), pa.array(topics.names()).take(pa.array(topic))], schema.names)

    return rows.select(*lists, "n", "size", "at", "tf", "often").mapInArrow(lean(run), schema)


def none(c: str) -> Column:
    return F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit("(none)"))


def drawn(text: str, key: str) -> Column:
    """52 bits of the hash of a row's key and text, as a number from 0 to 1."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.col(text), F.lit(SEED)), 12) / F.lit(float(1 << 52))


def _keyed(docs: DataFrame, text: str, key: str, topics: Topics) -> DataFrame:
    """(row: all columns of docs, _u: a number from 0 to 1, _n, _topic, _source, _lang)."""
    rows = docs.select(F.struct("*").alias("row"), drawn(text, key).alias("_u"), none("source").alias("_source"), none("lang").alias("_lang"), described(topics)(F.col(text), none("lang")).alias("_d"))
    return rows.select("row", "_u", "_source", "_lang", F.col("_d.n").alias("_n"), F.col("_d.topic").alias("_topic"))


def targets_of(totals: Mapping[str, float], temper: float, given: Mapping[str, float] | None) -> dict[str, float]:
    """Shares that sum to 1 over the values that have tokens."""
    raw = {v: (given.get(v, 0.0) if given else t**temper) for v, t in totals.items() if t > 0}
    whole = sum(raw.values())
    return {v: x / whole for v, x in raw.items()} if whole else {v: 0.0 for v in raw}


def rake(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray]) -> np.ndarray:
    """Weights of sum 1 whose marginals have the given shares; starts from the tokens' shares."""
    w = tokens / max(tokens.sum(), 1e-300)
    for _ in range(ROUNDS):
        off = 0.0
        for c, s in zip(codes, shares, strict=True):
            now = np.bincount(c, weights=w, minlength=len(s))
            off = max(off, float(np.abs(now - s)[now > 0].max(initial=0)))
            w = w * np.divide(s, now, out=np.zeros(len(s)), where=now > 0)[c]
        if off < TOLERANCE:
            break
    _warn(off)
    return w


def _warn(off: float) -> None:
    if off > 1e-6:
        warnings.warn(f"the targets can't all be met: a share is {off:.2g} off after {ROUNDS} rounds", stacklevel=3)


def probabilities(tokens: np.ndarray, w: np.ndarray, budget: float) -> np.ndarray:
    """min(1, scale * w / tokens), the scale set so that the expected tokens are budget (or all that w allows)."""
    ratio = np.divide(w, tokens, out=np.zeros(len(w)), where=tokens > 0)
    p = np.zeros(len(w))
    full = np.zeros(len(w), bool)
    for _ in range(len(w) + 1):
        rest = budget - tokens[full].sum()
        open_ = ~full & (ratio > 0)
        if not open_.any():
            break
        scale = max(rest, 0.0) / (ratio[open_] * tokens[open_]).sum()
        p[open_] = scale * ratio[open_]
        over = open_ & (p > 1)
        if not over.any():
            break
        full |= over
    p[full] = 1.0
    return np.clip(p, 0, 1)


def _small(cells: DataFrame, given: Mapping[str, Mapping[str, float]], budget: float) -> DataFrame:
    rows = sorted(tuple(r) for r in cells.collect())
    spark = cells.sparkSession
    schema = "_source string, _lang string, _topic string, probability double, weight double"
    if not rows:
        return spark.createDataFrame([], schema)
    tokens = np.array([r[3] for r in rows], float)
    codes, shares = [], []
    for i, name in enumerate(TEMPER):
        values, code = np.unique([r[i] for r in rows], return_inverse=True)
        of = np.bincount(code, weights=tokens)
        t = targets_of(dict(zip(values.tolist(), of.tolist(), strict=True)), TEMPER[name], given.get(name))
        codes.append(code)
        shares.append(np.array([t.get(v, 0.0) for v in values.tolist()]))
    w = rake(tokens, codes, shares)
    p = probabilities(tokens, w, budget * tokens.sum())
    wanted = [all(not given.get(name) or given[name].get(r[i], 0) > 0 for i, name in enumerate(TEMPER)) for r in rows]
    p = np.where((tokens == 0) & wanted, budget, p)
    expected = p * tokens
    weight = np.divide(w * expected.sum(), expected, out=np.zeros(len(w)), where=expected > 0)
    return spark.createDataFrame([(*r[:3], float(a), float(b)) for r, a, b in zip(rows, p, weight, strict=True)], schema)


def _large(cells: DataFrame, given: Mapping[str, Mapping[str, float]], budget: float) -> DataFrame:
    """The same as a table: for more cells than the driver should hold."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("_tokens")).first()[0] or 1
    names = {"source": "_source", "lang": "_lang", "topic": "_topic"}
    w = materialize(cells.withColumn("w", F.col("_tokens") / F.lit(float(total))), "rake")
    aims = {}
    for name, c in names.items():
        of = cells.groupBy(c).agg(F.sum("_tokens").alias("t")).filter("t > 0")
        if g := given.get(name):
            shares = spark.createDataFrame([(k, float(v)) for k, v in g.items()], f"{c} string, raw double")
            of = of.join(shares, c).select(c, "raw")
        else:
            of = of.select(c, F.pow("t", F.lit(TEMPER[name])).alias("raw"))
        aims[c] = materialize(of.crossJoin(F.broadcast(of.agg(F.sum("raw").alias("all")))).select(c, (F.col("raw") / F.col("all")).alias("aim")), "aim")
    for _ in range(ROUNDS):
        off = 0.0
        for c, aim in aims.items():
            now = w.groupBy(c).agg(F.sum("w").alias("now")).join(aim, c, "left").withColumn("aim", F.coalesce("aim", F.lit(0.0)))
            off = max(off, now.filter("now > 0").agg(F.max(F.abs(F.col("now") - F.col("aim")))).first()[0] or 0.0)
            after = materialize(w.join(now, c).withColumn("w", F.when(F.col("now") > 0, F.col("w") * F.col("aim") / F.col("now")).otherwise(0.0)).select(*w.columns), "rake")
            discard(w)
            w = after
        if off < TOLERANCE:
            break
    _warn(off)
    ratio = F.when(F.col("_tokens") > 0, F.col("w") / F.col("_tokens")).otherwise(0.0)
    lo, hi = 0.0, 1.0
    spent = lambda s: w.agg(F.sum(F.least(F.lit(1.0), ratio * s) * F.col("_tokens"))).first()[0] or 0.0
    aim = budget * total
    while spent(hi) < aim * (1 - 1e-9) and hi < 1e30:
        hi *= 8
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if spent(mid) < aim else (lo, mid)
    wanted = F.lit(True)
    for name, c in names.items():
        if g := given.get(name):
            wanted &= F.col(c).isin([v for v, share in g.items() if share > 0])
    p = F.when((F.col("_tokens") == 0) & wanted, F.lit(float(budget))).otherwise(F.least(F.lit(1.0), ratio * hi))
    got = spent(hi)
    return w.select(*names.values(), p.alias("probability"), F.when(p * F.col("_tokens") > 0, F.col("w") * got / (p * F.col("_tokens"))).otherwise(0.0).alias("weight"))


def sample(docs: DataFrame, given: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET, text: str = "text", key: str = "doc_id", most_cells: int = MOST_CELLS, with_text: bool = True) -> DataFrame:
    """The kept rows of docs with n_tokens, topic, probability and weight (columns of those names are replaced).

    with_text: with the text, for which the texts are read once more; without it the other columns come from the table of counts.
    One aggregation by cell, combined before the shuffle; the cells are broadcast only where their number is checked."""
    own = [c for c in docs.columns if c not in ("n_tokens", "topic", "probability", "weight") and (with_text or c != text)]
    beside = {} if with_text else {"_row": F.struct(*own), "_u": drawn(text, key)}
    rows = materialize(counted(docs, text, "lang", **beside), "counted", maxRecordsPerFile=SLICES_A_FILE)
    topics = learnt(rows)
    placed = _placed(rows, topics, *beside)
    if with_text:
        keyed = _keyed(docs, text, key, topics)
    else:
        placed = materialize(placed, "placed")
        keyed = placed.withColumnRenamed("_row", "row")
    cells = materialize(placed.groupBy("_source", "_lang", "_topic").agg(F.sum("_n").alias("_tokens")), "cells")
    discard(rows)
    small = cells.count() <= most_cells
    plan = (_small if small else _large)(cells, given or {}, budget)
    plan = plan.select("_source", "_lang", "_topic", F.col("probability").alias("_p"), F.col("weight").alias("_w"))
    joined = keyed.join(F.broadcast(plan) if small else plan, ["_source", "_lang", "_topic"])
    kept = joined.filter(F.col("_u") < F.col("_p"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in own], F.col("_n").alias("n_tokens"), F.col("_topic").alias("topic"), F.col("_p").alias("probability"), F.col("_w").alias("weight"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents sampled to the tempered targets, half of all tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return sample(docs, with_text=False).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "weight")
