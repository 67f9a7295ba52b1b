"""Benchmark decontamination by greedy string tiling.

The benchmark's token k-grams are hashed (Karp-Rabin) and sorted; a document's k-grams of benchmark words are looked up
in them, which joins document and item on shared seeds. To reach the coverage, a document must hold a number of an item's
seeds that follows from its length; so the item's commonest seeds, one fewer than that, can be left out of the join, and a
gram that every item holds pairs nothing. Pairs whose seeds can't cover enough are dropped.

The rest is tiled: the longest runs of equal, unmarked tokens are found by Karp-Rabin hashes of all runs of a length (the
length by bisection), confirmed on the tokens themselves, and marked from left to right, again and again, until no run of
MIN_TILE tokens is left. Memory is a few numbers a token of one document and one item, however often they repeat themselves.
Tiles may stand in any order, so reordered passages count in full. The share of the item's tokens in tiles is its coverage.

The benchmark is broadcast in chunks of at most CHUNK_CHARS characters, as many passes over the documents as that takes.

Cases: null and empty texts match nothing; an item of fewer than MIN_TILE tokens matches the documents that consist of exactly
its tokens; null and repeated ids keep a row for each match; of items that repeat an id, each is matched; a very long text is
a slice of its own; empty tables give an empty result (documents stay as they are); extra columns pass through the filter,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.common import NON_WORD, Words, lean, mix, slices, table, text_buffers

MIN_TILE = 4
COVERAGE = 0.5
CHUNK_CHARS = 4_000_000
#: Seeds that are looked up at a time.
SEEDS_AT_ONCE = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 1 << 20


def _grams(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place."""
    out = h[at]
    for j in range(1, k):
        out = mix(out * _STEP + h[at + j])
    return out


class _Runs:
    """Hashes of all runs of a length over a text of tokens, by doubling: a run of any length is two of a power of two."""

    def __init__(self, h: np.ndarray):
        self.levels = [mix(h + _STEP)]

    def of(self, length: int) -> np.ndarray:
        """One hash a place; places too near the end are cut off."""
        e = length.bit_length() - 1
        while len(self.levels) <= e:
            half, last = 1 << len(self.levels) - 1, self.levels[-1]
            self.levels.append(mix(last[:-half] * _STEP + last[half:]) if len(last) > half else last[:0])
        part = self.levels[e]
        n = len(self.levels[0]) - length + 1
        if n <= 0 or not len(part):
            return part[:0]
        return mix(part[:n] * _STEP + part[length - (1 << e) :][:n] + np.uint64(length))


def tiles(doc: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two texts of token numbers, by running Karp-Rabin.

    Tiles (document place, item place, length) in the order of marking: longest first, then by document place, then item place."""
    runs_d, runs_p = (_Runs(x.astype(np.uint64)) for x in (doc, item))
    free_d, free_p = np.ones(len(doc), bool), np.ones(len(item), bool)

    def shared(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of free runs of the length that both texts have, and their hashes."""

        def places(runs: _Runs, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            h = runs.of(length)
            whole = np.concatenate([[0], np.cumsum(free)])
            at = np.flatnonzero(whole[length:] - whole[:-length] == length) if len(h) else np.zeros(0, np.int64)
            return at, h[at]

        (d, hd), (p, hp) = places(runs_d, free_d), places(runs_p, free_p)
        ok, ok_p = np.isin(hd, hp), np.isin(hp, hd)
        return d[ok], hd[ok], p[ok_p], hp[ok_p]

    out = []
    most = min(len(doc), len(item))
    while most >= k:
        low, high = k - 1, most  # a run of `low` tokens is shared, or low is too short to count
        while low < high:
            mid = (low + high + 1) // 2
            if len(shared(mid)[0]):
                low = mid
            else:
                high = mid - 1
        if low < k:
            break
        d, hd, p, hp = shared(low)
        of: dict[int, list[int]] = {}
        for x, y in zip(hp.tolist(), p.tolist(), strict=True):
            of.setdefault(x, []).append(y)
        left = 0
        marked = False
        for x, at in zip(hd.tolist(), d.tolist(), strict=True):
            if at < left:
                continue
            queue = of[x]
            kept = []
            for n, y in enumerate(queue):
                if not free_p[y : y + low].all():
                    continue  # marked for good
                if (doc[at : at + low] == item[y : y + low]).all():  # Karp-Rabin confirms on the tokens
                    free_d[at : at + low] = free_p[y : y + low] = False
                    out.append((at, y, low))
                    left, marked = at + low, True
                    kept += queue[n + 1 :]
                    break
                kept.append(y)
            of[x] = kept
        most = low if marked else low - 1
    return out


@dataclass
class Seeds:
    """The benchmark: of each item its id, token numbers and hashes of its k-grams by place; the seeds that are joined,
    sorted, with the item of each; a bit table of its words; number has the token numbers."""

    ids: list
    tokens: list[np.ndarray]
    grams: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    words: np.ndarray
    number: dict[bytes, int]
    short: dict[bytes, list[int]]

    @staticmethod
    def of(rows: list[tuple[object, str]], k: int, coverage: float) -> Seeds:
        data, off = text_buffers(pc.utf8_lower(pa.array([t for _, t in rows], pa.string())))
        w = Words(data, off, NON_WORD, lower=False)
        h = w.hashes()
        number: dict[bytes, int] = {}
        every = np.array([number.setdefault(w.data[a:z].tobytes(), len(number)) for a, z in zip(w.start.tolist(), w.end.tolist(), strict=True)], np.int64)
        tokens = [every[w.first[i] : w.first[i + 1]] for i in range(len(rows))]
        at = np.flatnonzero(np.arange(len(h)) + k <= w.first[1:][w.row]) if len(h) else np.zeros(0, np.int64)
        g, item = _grams(h, at, k), w.row[at]
        _, inverse = np.unique(g, return_inverse=True)
        key = np.unique(inverse * len(rows) + item)
        items_of = np.bincount(key // len(rows), minlength=1)  # how many items have each gram
        grams, hashes, owner = [], [], []
        for i in range(len(rows)):
            part = slice(*np.searchsorted(item, [i, i + 1]))
            mine = g[part]
            grams.append(mine)
            # tiles of k tokens and more that cover enough hold so many seeds at least; places of rare grams first
            need = max(1, -(-int(np.ceil(coverage * len(tokens[i]))) // k))
            rare = np.argsort(items_of[inverse[part]], kind="stable")[: max(0, len(mine) - need + 1)]
            hashes.append(np.unique(mine[rare]))
            owner.append(np.full(len(hashes[-1]), i))
        hashes_, owner_ = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hashes, owner))
        order = np.argsort(hashes_, kind="stable")
        words = np.zeros(_BITS, bool)
        words[(h % np.uint64(_BITS)).astype(np.int64)] = True
        short: dict[bytes, list[int]] = {}
        for i, t in enumerate(tokens):
            if 0 < len(t) < k:
                short.setdefault(t.tobytes(), []).append(i)
        return Seeds([i for i, _ in rows], tokens, grams, hashes_[order], owner_[order].astype(np.int64), words, number, short)

    def _numbers(self, w: Words, row: int) -> np.ndarray:
        """A row's tokens by number; -1 for words that no item has."""
        part = slice(w.first[row], w.first[row + 1])
        return np.array([self.number.get(w.data[a:z].tobytes(), -1) for a, z in zip(w.start[part].tolist(), w.end[part].tolist(), strict=True)], np.int64)

    def matches(self, data: np.ndarray, offsets: np.ndarray, k: int, coverage: float) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, tiles, tokens in tiles) of a slice's rows, where they reach the coverage."""
        w = Words(data, offsets, NON_WORD, lower=False)
        h = w.hashes()
        if self.short:
            for row in np.flatnonzero((w.count > 0) & (w.count < k)).tolist():
                for i in self.short.get(self._numbers(w, row).tobytes(), ()):
                    yield row, i, 1, int(w.count[row])
        if len(h) < k or not len(self.hashes):
            return
        known = self.words[(h % np.uint64(_BITS)).astype(np.int64)]
        run = np.convolve(known, np.ones(k, np.int32), "valid") == k
        at = np.flatnonzero(run)
        at = at[at + k <= w.first[1:][w.row[at]]]
        g, row = _grams(h, at, k), w.row[at]
        hit = np.flatnonzero(self.hashes[np.minimum(np.searchsorted(self.hashes, g), len(self.hashes) - 1)] == g)
        if not len(hit):
            return
        # each gram of a row once
        by = hit[np.lexsort((g[hit], row[hit]))]
        once = np.concatenate([[True], (row[by][1:] != row[by][:-1]) | (g[by][1:] != g[by][:-1])])
        r, x = row[by][once], g[by][once]
        lo, hi = np.searchsorted(self.hashes, x, "left"), np.searchsorted(self.hashes, x, "right")
        pairs: list[np.ndarray] = []
        for a, z in slices(np.concatenate([[0], np.cumsum(hi - lo)]), SEEDS_AT_ONCE):
            n = (hi - lo)[a:z]
            past = np.cumsum(n)
            who = np.repeat(lo[a:z] - past + n, n) + np.arange(past[-1])
            pairs.append(np.unique(np.repeat(r[a:z], n) * len(self.ids) + self.item[who]))
        last, numbers, own = -1, np.zeros(0, np.int64), g[:0]
        for pair in np.unique(np.concatenate(pairs)).tolist():
            row_, i = divmod(pair, len(self.ids))
            size = len(self.tokens[i])
            if row_ != last:
                own = g[slice(*np.searchsorted(row, [row_, row_ + 1]))]
                numbers = np.zeros(0, np.int64)
                last = row_
            if (np.convolve(np.isin(self.grams[i], own), np.ones(k, np.int32)) > 0).sum() < coverage * size:  # tokens under any seed
                continue
            if not len(numbers):
                numbers = self._numbers(w, row_)
            found = tiles(numbers, self.tokens[i], k)
            tokens = sum(n for _, _, n in found)
            if tokens >= coverage * size:
                yield row_, i, len(found), tokens


def chunks(benchmark: DataFrame, text: str, key: str, k: int, coverage: float) -> Iterator[Seeds]:
    """The benchmark's seeds in chunks of bounded size."""
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // CHUNK_CHARS)
    for c in range(n):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == c).collect()
        if part:
            yield Seeds.of(sorted(((r["id"], r["text"]) for r in part), key=lambda r: (r[0] is None, r[0], r[1])), k, coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", coverage: float = COVERAGE, k: int = MIN_TILE) -> DataFrame:
    """(key, item, n_tiles, tokens, item_tokens, coverage) of every document and item of at least the coverage. No shuffle."""
    kinds = dict(docs.dtypes)[key], dict(benchmark.dtypes)[item]
    schema = f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, n_tiles int, tokens int, item_tokens int, coverage double"
    sc = docs.sparkSession.sparkContext
    out = None
    for seeds in chunks(benchmark, text, item, k, coverage):
        shared = sc.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            s = shared.value
            for b in batches:
                data, off = text_buffers(pc.utf8_lower(b.column("text")))
                for i, j in slices(off):
                    if found := list(s.matches(data, off[i : j + 1], k, coverage)):
                        rows, items, n, tokens = (np.array(x) for x in zip(*found, strict=True))
                        sizes = np.array([len(s.tokens[x]) for x in items])
                        ids = b.column(key).take(pa.array(rows + i))
                        of = pa.array([s.ids[x] for x in items])
                        yield pa.RecordBatch.from_arrays([ids, of, pa.array(n, pa.int32()), pa.array(tokens, pa.int32()), pa.array(sizes, pa.int32()), pa.array(tokens / sizes)], [key, item, "n_tiles", "tokens", "item_tokens", "coverage"])

        one = docs.select(key, F.col(text).alias("text")).mapInArrow(lean(run), schema)
        out = one if out is None else out.union(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", coverage: float = COVERAGE, k: int = MIN_TILE) -> DataFrame:
    """docs without the rows that hold a benchmark item to at least the coverage, with all their columns. No shuffle."""
    sc = docs.sparkSession.sparkContext
    for seeds in chunks(benchmark, "text", item, k, coverage):
        shared = sc.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, off = text_buffers(pc.utf8_lower(b.column(text)))
                keep = np.ones(b.num_rows, bool)
                for i, j in slices(off):
                    for row, *_ in shared.value.matches(data, off[i : j + 1], k, coverage):
                        keep[i + row] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose tiles cover at least half of the item."""
    return contaminated(table(spark, sf_dir, "documents", spread=True), table(spark, sf_dir, "benchmark"))
