"""Profiles and numeric stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.functions import terms as T


def top(df: DataFrame, column: str, n: int | None = None, count: str = "n") -> DataFrame:
    """Value counts, NULL left out, largest first, ties by value."""
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count)).orderBy(F.desc(count), column)
    return out.limit(n) if n else out


def fill_rates(df: DataFrame, empty: dict[str, Column]) -> DataFrame:
    """(field, filled, pct) from one pass: empty has a test of emptiness for each field."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(~F.coalesce(e, F.lit(True))).alias(c) for c, e in empty.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in empty]))
    return row.select("_n", pairs.alias("f")).select("f.field", "f.filled", F.when(F.col("_n") > 0, F.round(100.0 * F.col("f.filled") / F.col("_n"), 1)).otherwise(0.0).alias("pct"))


#: Bins of a pass of exact_quantiles, and how many values it sorts on the driver at the end, at most, for each rank.
BINS, MOST_SORTED = 1024, 4096
INF = float("inf")


def exact_quantiles(df: DataFrame, column: str | Column, at: tuple[float, ...]) -> list[float | None]:
    """Exact quantiles with linear interpolation, for any number of rows.

    Histograms over ever smaller ranges close in on the ranks: a pass is one scan with a count for each bin, so no task
    holds the values (percentile() keeps all distinct ones in one)."""
    c = F.col(column) if isinstance(column, str) else column
    v = df.select(c.cast("double").alias("v")).filter("v is not null and not isnan(v)")
    n, lo, hi = v.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if n and (lo == -INF or hi == INF):  # ends that no bin can span: rank them apart
        return _with_infinities(v, n, at)
    if not n:
        return [None] * len(at)
    spots = [(n - 1) * p for p in at]
    ranks = {r for h in spots for r in (int(h), min(int(h) + 1, n - 1))}
    within = {r: (lo, hi, 0, n) for r in ranks}  # lowest and highest value, rows below, rows inside
    while wide := sorted({x for x in within.values() if x[0] < x[1] and x[3] > MOST_SORTED}):
        inside = F.expr(" ".join(f"WHEN v >= {a!r}D AND v <= {b!r}D THEN {i}" for i, (a, b, _, _) in enumerate(wide)).join(("CASE ", " END")))
        low, width = (F.create_map(*[F.lit(x) for i, w in enumerate(wide) for x in (i, float(f(w)))]) for f in (lambda w: w[0], lambda w: w[1] - w[0]))
        parts = v.withColumn("i", inside).filter("i is not null")
        bin_ = F.least(F.floor((F.col("v") - low[F.col("i")]) / width[F.col("i")] * BINS), F.lit(BINS - 1))
        rows = parts.groupBy("i", bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).orderBy("i", "bin").collect()
        for r, w in within.items():
            if w in wide:
                below = w[2]
                for row in (x for x in rows if x["i"] == wide.index(w)):
                    if below + row["n"] > r:
                        within[r] = (row["a"], row["b"], below, row["n"])
                        break
                    below += row["n"]
    value = {r: w[0] for r, w in within.items() if w[0] == w[1]}
    left = {r: w for r, w in within.items() if r not in value}
    if left:  # one scan for all ranges
        inside = reduce(lambda x, y: x | y, [F.col("v").between(w[0], w[1]) for w in set(left.values())])
        held = sorted(x["v"] for x in v.filter(inside).collect())
        for r, w in left.items():
            value[r] = [x for x in held if w[0] <= x <= w[1]][r - w[2]]
    return [value[int(h)] + (value[min(int(h) + 1, n - 1)] - value[int(h)]) * (h - int(h)) for h in spots]


def _with_infinities(v: DataFrame, n: int, at: tuple[float, ...]) -> list[float | None]:
    """exact_quantiles() of a column that holds infinities; half way to one is that one."""
    low, high = v.agg(F.count_if(F.col("v") == -INF), F.count_if(F.col("v") == INF)).first()
    inner = n - low - high
    spots = [(n - 1) * p for p in at]
    ranks = sorted({r for h in spots for r in (int(h), min(int(h) + 1, n - 1))})
    mine = [r for r in ranks if low <= r < low + inner]
    held = exact_quantiles(v.filter((F.col("v") > -INF) & (F.col("v") < INF)), "v", tuple((r - low) / max(inner - 1, 1) for r in mine)) if mine else []
    value = dict(zip(mine, held, strict=True)) | {r: -INF if r < low else INF for r in ranks if r not in mine}
    pairs = [(value[int(h)], value[min(int(h) + 1, n - 1)], h - int(h)) for h in spots]
    return [a if a == b or not f else a + (b - a) * f for a, b, f in pairs]


def quantiles(df: DataFrame, column: str, at: tuple[float, ...] = (0.01, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """One row of exact quantiles with linear interpolation."""
    names = [f"p{round(100 * p)}" for p in at]
    return df.sparkSession.createDataFrame([tuple(exact_quantiles(df, column, at))], ", ".join(f"{x} double" for x in names))


def moments(column: str) -> list[Column]:
    """Bias-corrected skewness and excess kurtosis."""
    n, g1, g2 = F.count(column), F.skewness(column), F.kurtosis(column)
    return [(g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"), ((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis")]


def average_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Ranks with ties at their mean, from counts by value: a window over values, not over rows."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.orderBy(column).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.join(values.withColumn(name, before + (F.col("_c") + 1) / 2).drop("_c"), column, "left")


def histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """(bin, low, high, n) over half-open bins; empty ones stay."""
    c = F.col(column)
    place = reduce(lambda acc, e: acc + (c >= e).cast("int"), edges, F.lit(0))
    bins = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False), 1)]
    counts = df.filter((c >= edges[0]) & (c < edges[-1])).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    return df.sparkSession.createDataFrame(bins, "bin int, low double, high double").join(counts, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def pareto(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values with the running share of their sum."""
    most = top(df, column, n)
    order = W.orderBy(F.desc("n"), column)
    total = most.agg(F.sum("n").alias("_t"))
    return most.crossJoin(F.broadcast(total)).select(column, "n", F.round(100.0 * F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0)) / F.col("_t"), 1).alias("running_pct"))


def fences(q1: float | None, q3: float | None) -> tuple[Column, Column]:
    if q1 is None or q3 is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    return F.lit(max(0.0, q1 - 1.5 * (q3 - q1))), F.lit(q3 + 1.5 * (q3 - q1))


def iqr_fences(df: DataFrame, column: str) -> DataFrame:
    """One row: low and high fence, outliers and their share."""
    low, high = fences(*exact_quantiles(df, column, (0.25, 0.75)))
    out = (F.col(column) < low) | (F.col(column) > high)
    return df.agg(F.count_if(out).alias("outliers"), (F.count_if(out) / F.count(column)).alias("share")).select(low.alias("low"), high.alias("high"), "outliers", "share")


def clip(c: Column, low: Column, high: Column) -> Column:
    """Into the bounds; NULL stays NULL, which least and greatest alone would not keep."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def winsorize(df: DataFrame, column: str, out: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    a, b = (F.lit(x).cast("double") for x in exact_quantiles(df, column, (low, high)))
    return df.withColumn(out, clip(F.col(column), a, b))


def robust_scale(df: DataFrame, column: str, out: str) -> DataFrame:
    """(x - median) / IQR, or x - median without spread."""
    a, m, b = exact_quantiles(df, column, (0.25, 0.5, 0.75))
    spread = 1.0 if a is None or a == b else b - a
    return df.withColumn(out, (F.col(column) - F.lit(m)) / spread)


def fix_salary(c: Column, description: Column) -> Column:
    """Dollars entered as VND, and yearly pay of a text that speaks of years."""
    yearly = F.coalesce(F.lower(description).rlike("(?U)/ ?năm|/ ?year|per year|một năm"), F.lit(False))
    return F.when(c.between(100, 10_000), c * T.USD_VND).when((c > 200e6) & yearly, c / 12).otherwise(c)


def normalise_salaries(df: DataFrame, low: str, high: str, description: str) -> DataFrame:
    """Fix, hard bounds, IQR outliers, winsorized copies and logs. Two passes: statistics, then rows with them broadcast."""
    fixed = df.withColumn(low, fix_salary(F.col(low), F.col(description))).withColumn(high, fix_salary(F.col(high), F.col(description)))
    off = lambda c: F.coalesce((F.col(c) < T.MONTHLY_MIN_VND) | (F.col(c) > T.MONTHLY_MAX_VND), F.lit(False))
    fixed = fixed.withColumn("salary_suspect", off(low) | off(high))
    fixed = fixed.withColumn(low, F.when(~F.col("salary_suspect"), F.col(low))).withColumn(high, F.when(~F.col("salary_suspect"), F.col(high)))
    rep = F.coalesce(F.col(high), F.col(low))
    under, over = fences(*exact_quantiles(fixed, rep, (0.25, 0.75)))
    out = fixed.withColumn("is_outlier_salary", F.coalesce((rep < under) | (rep > over), F.lit(False)))
    for c in (low, high):
        a, b = (F.lit(x).cast("double") for x in exact_quantiles(fixed, c, (0.01, 0.99)))
        out = out.withColumn(f"{c}_capped", clip(F.col(c), a, b)).withColumn(f"log_{c}", F.log1p(f"{c}_capped"))
    return out
