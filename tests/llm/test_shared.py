"""What driver and workers share in files."""

import os

import numpy as np

from vacatia.llm import blockmax, common


def test_shared_arrays_have_one_copy(spark):
    """On a mounted folder the one file is mapped where it is; pieces are joined."""
    a = np.arange(1000)
    file = common.share(spark, "test", {"a": a, "b": common.Pieces(np.uint16, 1000, (a[i : i + 300] for i in range(0, 1000, 300))), "none": a[:0]})
    assert os.path.dirname(file) == common.work_dir(spark).removeprefix("file://") + "/vacatia"
    got = common.shared(file)
    assert (got["a"] == a).all() and (got["b"] == a).all() and got["b"].dtype == np.uint16 and len(got["none"]) == 0
    assert not any(os.path.basename(file) in f for f in spark.sparkContext.listFiles)


def test_lists_are_mapped_not_copied(spark, monkeypatch):
    """Lists laid out in pieces are those made in memory, and a process that maps them holds no copy."""
    monkeypatch.setattr(blockmax, "PIECE", 700)
    rng = np.random.default_rng(3)
    sizes = [0, 1, 2, 5, 40, 290, 290, 3, 130, 300, 1, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    row = np.concatenate([np.sort(rng.permutation(300)[:k]) for k in sizes])
    weight = rng.random(len(row))
    made = blockmax.Lists(300, first, row, weight, 12)
    file = common.share(spark, "lists", blockmax.Lists.laid_out(300, first, lambda post: (row[post], weight[post]), 12))
    got = blockmax.Lists.mapped(300, common.shared(file))
    for name in ("size", "may", "at", "table", "place", "exact", "rough", "maxima"):
        assert (getattr(got, name) == getattr(made, name)).all() and getattr(got, name).flags.aligned, name
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(got.tables, made.tables, strict=True))
    for x in (got.exact, got.rough, *(w for rows, w in got.tables if len(rows))):
        while not isinstance(x, np.memmap):
            x = x.base
    query = np.array([0, 4, 9]), np.array([1, 3, 5, 9, 2, 4, 6, 8, 9]), None, np.full(2, 1e-8), np.ones(2, bool), np.ones(300, bool), 10
    assert all((a == b).all() for a, b in zip(blockmax.best_rows(got, *query), blockmax.best_rows(made, *query), strict=True))
