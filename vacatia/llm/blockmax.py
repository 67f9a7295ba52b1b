"""Posting lists with block maxima, and the search for the best rows of a group of queries, which is exact.

Lists are split at a pivot: a list that many rows and many queries of the group share is dense, with a value for each row and
a maximum for each block of BLOCK rows; the other lists are walked. A block is looked into for a query only where what the
walked lists give there plus the dense lists' block maxima can reach the score that counts, and a row only where its sum in
single precision, plus more than that can be off, can reach it. What is left is scored in double precision.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np

from vacatia.llm.common import Pieces, slices

BLOCK = 128
#: Queries that are searched at a time, and the sums (queries times rows) that are walked at a time (they should stay in cache).
GROUP, WALKED = 256, 1 << 16
#: Lists that are walked lie in tables of these widths, and of twice the last as often as it takes.
WIDTHS = (1, 2, 4, 8, 12, 16, 24, 32, 48, 64, 96, 128)
#: A list may be dense if one row in DENSE has it, and is so if (share of rows) * (share of the group's queries) is more
#: than PIVOT: from there a product of matrices costs less than walking.
DENSE, PIVOT = 64, 0.0015
#: Blocks that a query without a score to reach looks into first, those of the highest bounds.
FIRST = 4
POSTINGS_AT_ONCE = 1_000_000
#: Values of a piece of lists that are laid out for other processes.
PIECE = 1 << 19
NOWHERE = np.iinfo(np.int64).max
Take = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def one_thread() -> None:
    """Matrix products of this process take one thread: a task has one core, and threads that wait use up others'."""
    for f in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        lib = ctypes.CDLL(str(f))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(lib, name):
                getattr(lib, name)(1)
                return


class Lists:
    """Lists over n rows; list t has the rows row[first[t]:first[t + 1]] with their weights.

    tables: of the lists of each width, rows and weights, filled up with row 0 and weight 0; table and place: where a list is."""

    def __init__(self, n: int, first: np.ndarray, row: np.ndarray, weight: np.ndarray, dense: int = DENSE):
        self._plan(n, first, dense)
        take = lambda post: (row[post], weight[post])
        self.exact = self._exact(np.flatnonzero(self.may), first, take)
        self.rough = self.exact.astype(np.float32)
        self.maxima = self._maxima(self.rough)
        self.tables = [self._table(w, np.flatnonzero(self.table == k), first, take) for k, w in enumerate(self.widths)]

    def _plan(self, n: int, first: np.ndarray, dense: int) -> None:
        """Where each list is to lie."""
        self._rows(n)
        self.size = np.diff(first)
        self.may = self.size * dense > n
        self.at = np.cumsum(self.may) - 1
        self.widths = list(WIDTHS)
        while self.widths[-1] < self.size.max(initial=1):
            self.widths.append(2 * self.widths[-1])
        self.table = np.searchsorted(self.widths, self.size).astype(np.uint8)
        self.place = np.zeros(len(self.size), np.int64)
        for k in range(len(self.widths)):
            lists = np.flatnonzero(self.table == k)
            self.place[lists] = np.arange(len(lists))

    def _rows(self, n: int) -> None:
        self.n, self.blocks = n, -(-n // BLOCK)
        self.width = self.blocks * BLOCK
        self.kind = np.uint16 if n <= 1 << 16 else np.int64

    def _postings(self, lists: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some lists: where each posting is, its list (a place in lists) and its place in that."""
        size = self.size[lists]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(first[lists], size) + within, np.repeat(np.arange(len(lists)), size), within

    def _exact(self, lists: np.ndarray, first: np.ndarray, take: Take) -> np.ndarray:
        out = np.zeros((len(lists), self.width))
        for t in range(len(lists)):  # one after the other, so that what it takes stays small
            post, _, _ = self._postings(lists[t : t + 1], first)
            row, weight = take(post)
            out[t, row] = weight
        return out

    def _maxima(self, rough: np.ndarray) -> np.ndarray:
        return rough.reshape(len(rough), self.blocks, BLOCK).max(axis=2)

    def _table(self, width: int, lists: np.ndarray, first: np.ndarray, take: Take) -> tuple[np.ndarray, np.ndarray]:
        rows, weights = np.zeros((len(lists), width), self.kind), np.zeros((len(lists), width))
        post, *at = self._postings(lists, first)
        rows[tuple(at)], weights[tuple(at)] = take(post)
        return rows, weights

    @classmethod
    def laid_out(cls, n: int, first: np.ndarray, take: Take, dense: int = DENSE) -> dict[str, np.ndarray | Pieces]:
        """The arrays of the lists, for share() and mapped(): in pieces of at most PIECE values, or one list.

        take: rows and weights of the postings at given places."""
        s = cls.__new__(cls)
        s._plan(n, first, dense)
        may = np.flatnonzero(s.may)

        def dealt(lists: np.ndarray, width: int) -> Iterator[np.ndarray]:
            step = max(1, PIECE // width)
            return (lists[i : i + step] for i in range(0, len(lists), step))

        def pieces(kind: type, lists: np.ndarray, width: int, values: int, of: Callable[[np.ndarray], np.ndarray]) -> Pieces:
            return Pieces(kind, len(lists) * values, (of(some).ravel() for some in dealt(lists, width)))

        rough = lambda some: s._exact(some, first, take).astype(np.float32)
        out: dict[str, np.ndarray | Pieces] = {k: getattr(s, k).astype(np.int32) for k in ("size", "at", "place")}
        out |= {"may": s.may, "table": s.table, "exact": pieces(float, may, s.width, s.width, lambda some: s._exact(some, first, take))}
        out |= {"rough": pieces(np.float32, may, s.width, s.width, rough), "maxima": pieces(np.float32, may, s.width, s.blocks, lambda some: s._maxima(rough(some)))}
        for k, w in enumerate(s.widths):
            lists = np.flatnonzero(s.table == k)
            for x, (name, kind) in enumerate((("rows", s.kind), ("weights", float))):
                out[f"{name}{w}"] = pieces(kind, lists, w, w, lambda some, w=w, x=x: s._table(w, some, first, take)[x])
        return out

    @classmethod
    def mapped(cls, n: int, arrays: Mapping[str, np.ndarray]) -> Lists:
        """Of what laid_out() gave, where it lies: nothing is copied."""
        s = cls.__new__(cls)
        s._rows(n)
        x = {k: np.asarray(v) for k, v in arrays.items()}
        s.size, s.at, s.place, s.may, s.table = (x[k] for k in ("size", "at", "place", "may", "table"))
        s.exact, s.rough, s.maxima = (x[k].reshape(-1, w) for k, w in (("exact", s.width), ("rough", s.width), ("maxima", s.blocks)))
        s.widths = sorted(int(k[4:]) for k in x if k.startswith("rows"))
        s.tables = [(x[f"rows{w}"].reshape(-1, w), x[f"weights{w}"].reshape(-1, w)) for w in s.widths]
        return s


def best_rows(s: Lists, first: np.ndarray, term: np.ndarray, factor: np.ndarray | None, least: np.ndarray, fresh: np.ndarray, single: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of every row that can be among a query's k best, and perhaps others.

    first, term, factor: of each query the lists that it asks for (-1: none here) and what it multiplies them by (None: 1).
    least: a score that counts for each query. fresh: queries for which that is not yet the k-th best of any rows; single:
    rows whose scores may be counted for that."""
    n, m, width = s.n, len(first) - 1, s.width
    of = np.repeat(np.arange(m), np.diff(first))
    here = term >= 0
    of, term = of[here], term[here]
    times = None if factor is None else factor[here]
    dense = s.may & (np.bincount(term, minlength=len(s.size)) * s.size > PIVOT * m * n)
    lists = np.flatnonzero(dense)
    column = np.zeros(len(s.size), np.int64)
    column[lists] = np.arange(len(lists))
    values, most = s.rough[s.at[lists]], s.maxima[s.at[lists]]
    is_dense = dense[term]
    asked = np.zeros((m, len(lists)), np.float32)
    asked[of[is_dense], column[term[is_dense]]] = 1.0 if times is None else times[is_dense]
    part = _walked(s, of[~is_dense], term[~is_dense], None if times is None else times[~is_dense], m)
    bound = asked @ most
    # more than single precision can be off in a sum of as many terms, in any order; 3 for rounding of factors and weights
    slack = (np.diff(np.searchsorted(of[is_dense], np.arange(m + 1)))[:, None] + 3) * 2.0**-23 * (bound + part.max(axis=1, keepdims=True)) + 2e-6
    bound = bound + part.reshape(m, s.blocks, BLOCK).max(axis=2) + slack
    least = least.copy()

    def scores(block: int, some: np.ndarray) -> np.ndarray:
        cols = slice(block * BLOCK, min((block + 1) * BLOCK, n))
        out = asked[some] @ values[:, cols]
        out += part[some, cols]
        return out

    some = np.flatnonzero(fresh)
    if len(some) and single.sum() >= k:
        # the k-th best can't be under the k-th best of the rows that are looked into first
        looked = np.zeros((m, s.blocks), bool)
        deep = min(s.blocks, max(FIRST, -(-4 * k // BLOCK)))
        looked[some[:, None], np.argpartition(-bound[some], deep - 1, axis=1)[:, :deep]] = True
        top = np.full((m, k), -np.inf)
        for b in np.flatnonzero(looked.any(axis=0)):
            x = np.flatnonzero(looked[:, b])
            got = np.where(single[b * BLOCK : min((b + 1) * BLOCK, n)], scores(b, x) - slack[x, b, None], -np.inf)
            top[x] = -np.partition(-np.concatenate([top[x], got], axis=1), k - 1, axis=1)[:, :k]
        least[some] = np.maximum(least[some], top[some].min(axis=1))
    queries, rows, roughs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for b in range(s.blocks):
        alive = np.flatnonzero(bound[:, b] >= least)
        if len(alive):
            got = scores(b, alive)
            x, y = np.nonzero(got >= (least[alive] - slack[alive, b])[:, None])
            queries.append(alive[x])
            rows.append(b * BLOCK + y)
            roughs.append(got[x, y])
    query, row, rough = np.concatenate(queries), np.concatenate(rows), np.concatenate(roughs)
    order = np.argsort(query.astype(np.uint16), kind="stable")  # rows of a query are in order: block after block
    query, row, rough = query[order], row[order], rough[order]
    if len(some):
        # now all rows that count are known: their k-th best, less what it can be off, counts
        of_fresh = np.flatnonzero(fresh[query] & single[row])
        of_fresh = of_fresh[np.argsort(-rough[of_fresh])]
        of_fresh = of_fresh[np.argsort(query[of_fresh].astype(np.uint16), kind="stable")]
        kth = of_fresh[np.arange(len(of_fresh)) - np.searchsorted(query[of_fresh], query[of_fresh]) == k - 1]
        off = slack.max(axis=1)
        least[query[kth]] = np.maximum(least[query[kth]], rough[kth] - off[query[kth]])
        ok = rough >= least[query] - off[query]
        query, row = query[ok], row[ok]
    score = part[query, row]
    own, own_first = s.at[term[is_dense]], np.searchsorted(of[is_dense], np.arange(m + 1))
    count = np.diff(own_first)[query]
    for x, y in slices(np.concatenate([[0], np.cumsum(count)]), POSTINGS_AT_ONCE):
        past = np.cumsum(count[x:y])
        place = np.repeat(own_first[query[x:y]] - past + count[x:y], count[x:y]) + np.arange(past[-1])
        got = s.exact.ravel()[own[place] * width + np.repeat(row[x:y], count[x:y])]
        if times is not None:
            got *= times[is_dense][place]
        score[x:y] += np.bincount(np.repeat(np.arange(y - x), count[x:y]), weights=got, minlength=y - x)
    return query, row, score


def _walked(s: Lists, of: np.ndarray, term: np.ndarray, times: np.ndarray | None, m: int) -> np.ndarray:
    """queries x rows: sums over the lists that are walked."""
    part = np.empty((m, s.width))
    step = max(1, WALKED // s.width)
    for i in range(0, m, step):
        j = min(i + step, m)
        some = slice(*np.searchsorted(of, [i, j]))
        t, offset = term[some], (of[some] - i) * s.width
        kind = s.table[t]
        by = np.argsort(kind.astype(np.uint8), kind="stable")
        cut = np.searchsorted(kind[by], np.arange(len(s.tables) + 1)).tolist()
        total = sum((y - x) * rows.shape[1] for x, y, (rows, _) in zip(cut, cut[1:], s.tables, strict=False))
        cells, weights = np.empty(total, np.int64), np.empty(total)
        past = 0
        for x, y, (rows, values) in zip(cut, cut[1:], s.tables, strict=False):
            if x < y:
                own = by[x:y]
                at = s.place[t[own]]
                end = past + (y - x) * rows.shape[1]
                c, v = cells[past:end].reshape(y - x, -1), weights[past:end].reshape(y - x, -1)
                np.add(rows[at], offset[own, None], out=c)
                np.take(values, at, axis=0, out=v, mode="clip")
                if times is not None:
                    v *= times[some][own, None]
                past = end
        part[i:j] = np.bincount(cells, weights=weights, minlength=(j - i) * s.width).reshape(j - i, s.width)
    return part


@dataclass
class Best:
    """The best k (score, id) of each query so far, each id with its best score only; ties by the smaller id."""

    floor: np.ndarray  # a score that the k-th best reaches, or the least that counts
    k: int
    least_score: float = 1e-6

    def __post_init__(self) -> None:
        self.floor = np.maximum(self.floor, self.least_score)
        self.score, self.doc = np.zeros((len(self.floor), self.k)), np.full((len(self.floor), self.k), NOWHERE)

    def least(self, rows: np.ndarray | slice) -> np.ndarray:
        """The score from which a document can be in the result."""
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def fresh(self, rows: np.ndarray | slice) -> np.ndarray:
        return (self.doc[rows, -1] == NOWHERE) & (self.floor[rows] <= self.least_score)

    def add(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        """Candidates: query, score and id of each."""
        ok = score >= self.least(query)
        query, score, doc = query[ok], score[ok], doc[ok]
        rows = np.unique(query)
        if not len(rows):
            return
        q = np.concatenate([np.repeat(rows, self.k), query])
        s, d = np.concatenate([self.score[rows].ravel(), score]), np.concatenate([self.doc[rows].ravel(), doc])
        some = s > 0
        q, s, d = q[some], s[some], d[some]
        by = np.lexsort((-s, d, q))  # an id takes one of the k places, whatever the number of its rows
        q, s, d = q[by], s[by], d[by]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (d[1:] != d[:-1])
        q, s, d = q[once], s[once], d[once]
        by = np.lexsort((d, -s, q))
        q, s, d = q[by], s[by], d[by]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        self.score[rows], self.doc[rows] = 0.0, NOWHERE
        self.score[q[top], rank[top]], self.doc[q[top], rank[top]] = s[top], d[top]
