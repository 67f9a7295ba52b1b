"""Language identification of mixed-language text.

A word's script (from code point ranges) narrows its candidates to the languages learnt in that script. Each candidate
scores the word by the log probabilities of its byte trigrams, word edges included. Viterbi over the words of a text, with
a penalty for each switch, labels spans; a text in which no stretch of words favours another language by more than the
penalty needs no search, because there one language throughout is the best path. The language of most letters wins.

The model is fitted on a sample of at most MOST_ROWS rows (a parameter), by the order of a hash of their ids. So there are at
most as many languages; trigrams share BUCKETS places, and fewer where many languages would make the table of scores larger
than MOST_CELLS. Texts are scored in slices whose words times languages are bounded (one text at least).

Cases: null texts and texts without a letter are `und` with score 0; words without letters fit every language; letters of
a script that no language was learnt in make spans of `und`, and a text of only such gets the most frequent language
with score 0; null ids count as held out; repeated rows keep a row each; without anything to learn from all rows are
`und`; of languages that are equally good for a word or a text the first by name counts; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.common import LOWER, NON_WORD, SLICE_BYTES, Words, bounded_sample, lean, slices, table, text_buffers
from vacatia.llm.toxicity import held_out

MOST_ROWS = 20_000
SWITCH = 14.0
#: Least share of a language's letters in a script for it to be a candidate there.
LEAST_SHARE = 0.01
BUCKETS, MOST_CELLS = 1 << 16, 1 << 26
#: Scores (words times languages) of a slice.
MOST_SCORES = 1 << 24
_FAR = -60.0

# First code points of script ranges; letters outside the named ones are "other".
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({n for _, n in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_OF = np.array([NAMES.index(n) for _, n in SCRIPTS])
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def letters(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of the letters (their first bytes) and their scripts."""
    ascii_ = np.flatnonzero(((d >= 65) & (d <= 90)) | ((d >= 97) & (d <= 122)))
    lead = np.flatnonzero(d >= 0xC0)
    if not len(lead):
        return ascii_, np.full(len(ascii_), NAMES.index("latin"))
    b = [np.concatenate([d, np.zeros(4, np.uint8)])[lead + i].astype(np.int64) for i in range(4)]
    c = np.where(b[0] < 0xE0, (b[0] & 31) << 6 | b[1] & 63, np.where(b[0] < 0xF0, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63, (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63))
    c = np.minimum(c, 0x10FFFF)
    ok = _is_letter()[c]
    lead, c = lead[ok], c[ok]
    at = np.concatenate([ascii_, lead])
    script = np.concatenate([np.full(len(ascii_), NAMES.index("latin")), _OF[np.searchsorted(_STARTS, c, "right") - 1]])
    order = np.argsort(at, kind="stable")
    return at[order], script[order]


def trigrams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of a word, and each word's first place in that list."""
    inside = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    mid = np.flatnonzero(np.cumsum(inside[:-1]))
    size = w.end - w.start
    first = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    padded = np.concatenate([[0], w.data, [0]]).astype(np.uint32)
    left, right = padded[mid], padded[mid + 2]
    left[first] = 32
    right[first + size - 1] = 32
    code = left << np.uint32(16) | padded[mid + 1] << np.uint32(8) | right
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16), first


class Parsed:
    """Words of a slice with their scripts and numbers of letters."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        raw = data[offsets[0] : offsets[-1]]
        self.words = w = Words(LOWER[raw], offsets - offsets[0], NON_WORD, lower=False)
        self.raw = raw
        at, script = letters(raw)
        word = np.searchsorted(w.start, at, "right") - 1
        self.letters = np.bincount(word, minlength=len(w.start)) if len(w.start) else np.zeros(0, np.int64)
        per = np.bincount(word * len(NAMES) + script, minlength=len(w.start) * len(NAMES)).reshape(-1, len(NAMES)) if len(at) else np.zeros((len(w.start), len(NAMES)), np.int64)
        self.per_script = per
        self.script = per.argmax(axis=1) if len(per) else np.zeros(0, np.int64)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # langs x BUCKETS
    candidate: np.ndarray  # scripts x langs
    prior: np.ndarray

    def word_scores(self, p: Parsed) -> np.ndarray:
        """words x (langs + 1); the last is a script without a language."""
        n = len(p.words.start)
        out = np.zeros((n, len(self.langs) + 1), np.float32)
        if not n:
            return out
        codes, first = trigrams(p.words)
        codes >>= np.uint32(16 - int(self.table.shape[1]).bit_length() + 1)
        for i, row in enumerate(self.table):
            out[:, i] = np.add.reduceat(row[codes], first)
        out[:, :-1] -= out[:, :-1].max(axis=1, keepdims=True)
        fits = self.candidate[p.script]
        out[:, :-1] = np.where(fits, np.maximum(out[:, :-1], _FAR / 2), _FAR)
        out[:, -1] = np.where(fits.any(axis=1), _FAR, 0)
        out[p.letters == 0] = 0
        return out

    def path(self, s: np.ndarray) -> np.ndarray:
        """The best state of each word of one text."""
        start = np.append(self.prior, 0)
        total = s.sum(axis=0) + start
        best = int(total.argmax())
        gain = (s - s[:, best : best + 1]).astype(float)
        gain[0] += start - start[best]
        c = np.concatenate([np.zeros((1, gain.shape[1])), np.cumsum(gain, axis=0)])
        if ((c - np.minimum.accumulate(c, axis=0)).max(axis=0) <= SWITCH).all():
            return np.full(len(s), best, np.int32)
        return viterbi(s, start)


def viterbi(s: np.ndarray, start: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best states of n words (scores n x k): staying is free, any switch costs the same; of equal ones the first state."""
    n, k = s.shape
    stays, tops = np.empty((n, k), bool), np.empty(n, np.int32)
    v = s[0] + start.astype(float)
    for t in range(1, n):
        tops[t] = top = int(v.argmax())
        from_top = v[top] - switch
        stays[t] = v >= from_top
        v = np.where(stays[t], v, from_top) + s[t]
    out = np.empty(n, np.int32)
    out[-1] = int(v.argmax())
    for t in range(n - 1, 0, -1):
        out[t - 1] = out[t] if stays[t, out[t]] else tops[t]
    return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", most: int = MOST_ROWS) -> Model | None:
    """The model from at most `most` rows; docs must hold only rows to learn from. None without any."""
    some = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("_key"))
    few = bounded_sample(some, most, 10, "_key", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = np.array(b.column("lang").to_pylist(), object)
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off):
                p = Parsed(data, off[i : j + 1])
                if not len(p.words.start):
                    continue
                codes, first = trigrams(p.words)
                size = np.diff(np.append(first, len(codes)))
                of_word = names[i:j][p.words.row]
                for name in set(names[i:j]):
                    mine = (of_word == name) & (p.letters > 0)
                    n = np.bincount(codes[np.repeat(mine, size)], minlength=BUCKETS)
                    scripts = p.per_script[mine].sum(axis=0)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * (len(at) + len(NAMES) + 1), pa.string()), pa.array(np.concatenate([at, BUCKETS + np.arange(len(NAMES) + 1)])), pa.array(np.concatenate([n[at], scripts, [(names[i:j] == name).sum()]]))],
                        ["lang", "at", "n"],
                    )

    counts = few.select("lang", "text").mapInArrow(lean(counted), "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # of at most MOST_ROWS texts, and at most BUCKETS for each language
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    place = {x: i for i, x in enumerate(langs)}
    n = np.zeros((len(langs), BUCKETS + len(NAMES) + 1), np.float32)
    for r in rows:
        n[place[r["lang"]], r["at"]] = r["n"]
    grams, scripts, texts = n[:, :BUCKETS], n[:, BUCKETS:-1], n[:, -1]
    while grams.size > MOST_CELLS and grams.shape[1] > 256:
        grams = grams[:, ::2] + grams[:, 1::2]
    used = max(1, int(grams.any(axis=0).sum()))
    log = np.log((grams + 0.2) / (grams.sum(axis=1, keepdims=True) + 0.2 * used))
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, log.astype(np.float32), (share >= LEAST_SHARE).T, np.log((texts + 1) / (texts.sum() + len(langs))))


def identify(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, spans) of every row; spans: array of (lang, start, end) in code points, one for each stretch."""
    kind = dict(docs.dtypes)[key]
    spans_type = "array<struct<lang: string, start: long, end: long>>"
    if model is None:
        return docs.select(key, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast(spans_type).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages
    fields = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, "und"], object)
        und = len(m.langs)
        for b in batches:
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off, min(SLICE_BYTES, max(4096, MOST_SCORES // (und + 1)))):
                p = Parsed(data, off[i : j + 1])
                w, s = p.words, m.word_scores(p)
                char = np.concatenate([[0], np.cumsum((p.raw & 0xC0) != 0x80)])
                langs, scores, spans = ["und"] * (j - i), np.zeros(j - i), [[] for _ in range(j - i)]
                for r in range(j - i):
                    a, z = w.first[r], w.first[r + 1]
                    n = p.letters[a:z]
                    total = n.sum()
                    if not total:
                        continue
                    states = m.path(s[a:z])
                    weight = np.bincount(states, weights=n, minlength=und + 1)
                    if weight[:und].any():
                        top = int(weight[:und].argmax())
                        scores[r] = weight[top] / total
                    else:
                        top = int(m.prior.argmax())
                    langs[r] = m.langs[top]
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(states)) + 1, [z - a]])
                    base = char[w.offsets[r]]
                    spans[r] = [{"lang": names[states[x]], "start": int(char[w.start[a + x]] - base), "end": int(char[w.end[a + y - 1]] - base)} for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(key).slice(i, j - i), pa.array(langs), pa.array(scores), pa.array(spans, fields)], [key, "lang_pred", "score", "spans"])

    return docs.select(key, F.col(text).alias("text")).mapInArrow(lean(run), f"`{key}` {kind}, lang_pred string, score double, spans {spans_type}")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt only from rows whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents", spread=True)
    out = held_out("doc_id", 3, 1)
    found = identify(docs, fit(docs.filter(~out)))
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["start"], s["end"])), ",")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", joined.alias("spans"))
