"""Keeping one row of several: latest, best, across sources; fuzzy groups within blocks."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.functions import terms as T
from vacatia.functions.arrays import merge_ci


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. order must be total, so that ties don't depend on partitions."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def ranked(df: DataFrame, keys: list[str], order: list[Column], winner: str) -> DataFrame:
    """All rows with kept and the key's winner, for reports of what was dropped for which row."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("kept", F.row_number().over(w) == 1).withColumn("winner", F.first(winner).over(w))


def across_sources(df: DataFrame, key: str, source: str, id_: str, order: list[Column]) -> DataFrame:
    """Rows of keys that several sources hold: one winner each, all others dropped, also those of the winner's source.

    Adds kept and also_on (source:id of the losers in rank order; empty for losers and for keys of one source)."""
    every = W.partitionBy(key)
    none = F.array().cast("array<string>")
    alone = df.filter(F.col(key).isNull()).withColumn("also_on", none).withColumn("kept", F.lit(True))  # they share no key
    n = df.filter(F.col(key).isNotNull()).withColumn("_sources", F.size(F.collect_set(source).over(every)))
    n = n.withColumn("_rank", F.when(F.col("_sources") > 1, F.row_number().over(every.orderBy(*order))).otherwise(1))
    losers = F.collect_list(F.when(F.col("_rank") > 1, F.struct("_rank", F.concat_ws(":", source, id_).alias("who")))).over(every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    also = F.when((F.col("_sources") > 1) & (F.col("_rank") == 1), F.transform(F.array_sort(losers), lambda x: x["who"])).otherwise(none)
    return n.withColumn("also_on", also).withColumn("kept", F.col("_rank") == 1).drop("_sources", "_rank").unionByName(alone)


def funnel(df: DataFrame, levels: list[list[Column]], source: Column) -> DataFrame:
    """(level, extra, same_source, cross_source): rows beyond the first of a key, and groups in one or several sources."""
    out = None
    for i, keys in enumerate(levels, 1):
        named = [k.alias(f"k{j}") for j, k in enumerate(keys)]
        groups = df.select(*named, source.alias("s")).groupBy(*[f"k{j}" for j in range(len(keys))]).agg(F.count("*").alias("n"), F.count_distinct("s").alias("sources")).filter("n > 1")
        row = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.count_if(F.col("sources") == 1).alias("same_source"), F.count_if(F.col("sources") > 1).alias("cross_source"))
        row = row.select(F.lit(i).cast("bigint").alias("level"), "*")
        out = row if out is None else out.union(row)
    return out


def title_tokens(c: Column) -> Column:
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+"), F.lit(0))), F.array(*map(F.lit, T.TITLE_STOPWORDS)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def _members_of(pairs: DataFrame, members: DataFrame, score: str) -> DataFrame:
    """(a, b, score), a < b: all pairs of members (k: class, id) of pairs of classes (k, other, score), which hold both
    orders and each class with itself. Rows are only joined, so no pair is shuffled, and adaptive execution splits large classes."""
    near = members.join(pairs, "k").select(F.col("id").alias("a"), score, F.col("other").alias("k"))
    return near.join(members.select("k", F.col("id").alias("b")), "k").filter("a < b").select("a", "b", score)


def similar_pairs(df: DataFrame, block: list[str], id_: str, title: str, least: float, digits: int | None = None) -> DataFrame:
    """(a, b, similarity) of rows of a block whose title words agree; similarity is rounded to so many digits after the comparison.

    Rows of a block with the same words are a class. Classes are joined on block and shared word, so only those with a common
    word meet, and each pair is counted where words meet; then members take their classes' places."""
    words = df.select(*block, F.col(id_).alias("id"), F.explode(title_tokens(F.col(title))).alias("word")).dropna(subset=[*block, "id"])
    base = words.groupBy(*block, "id").agg(F.sort_array(F.collect_set("word")).alias("words"))
    members = base.select(F.struct(*block, "words").alias("k"), "id")
    classes = members.select("k").distinct().select("k", F.size("k.words").alias("size"), F.explode("k.words").alias("word"), F.struct(*[F.col("k")[c].alias(c) for c in block]).alias("block"))
    other = classes.select("block", "word", F.col("k").alias("other"), F.col("size").alias("size_b"))
    met = classes.join(other, ["block", "word"]).groupBy("k", "other", "size", "size_b").agg(F.count("*").alias("both"))
    sim = F.col("both") / (F.col("size") + F.col("size_b") - F.col("both"))
    near = met.select("k", "other", sim.alias("similarity")).filter(F.col("similarity") >= least)
    return _members_of(near if digits is None else near.withColumn("similarity", F.round("similarity", digits)), members, "similarity")


def tfidf_pairs(df: DataFrame, block: list[str], id_: str, text: Column, least: float, digits: int | None = None) -> DataFrame:
    """(a, b, cosine) within a block: TF-IDF of words with idf = ln((1 + n) / (1 + df)) + 1 fitted per block, unit length;
    cosine is rounded to so many digits after the comparison.

    Rows of a block with the same words as often are a class; frequencies count its rows, and vectors are compared once a class."""
    words = df.select(*block, F.col(id_).alias("id"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))).alias("word")).dropna(subset=block)
    tf = words.groupBy(*block, "id", "word").agg(F.count("*").alias("tf"))
    members = tf.groupBy(*block, "id").agg(F.sort_array(F.collect_list(F.struct("word", "tf"))).alias("words")).select(F.struct(*block, "words").alias("k"), "id")
    n = df.groupBy(*block).agg(F.count("*").alias("n"))
    bags = members.groupBy("k").agg(F.count("*").alias("rows"))
    terms = bags.select("k", "rows", *[F.col("k")[c].alias(c) for c in block], F.explode("k.words").alias("t")).select("k", "rows", *block, "t.word", "t.tf")
    seen = terms.groupBy(*block, "word").agg(F.sum("rows").alias("df"))
    weight = terms.join(seen, [*block, "word"]).join(n, block).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = weight.groupBy("k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    shared = weight.filter("df > 1").select("k", *block, "word", "w")
    other = shared.select(*block, "word", F.col("k").alias("other"), F.col("w").alias("w_b"))
    dots = shared.join(other, [*block, "word"]).groupBy("k", "other").agg(F.sum(F.col("w") * F.col("w_b")).alias("dot"))
    both = dots.join(norm, "k").join(norm.select(F.col("k").alias("other"), F.col("norm").alias("norm_b")), "other")
    near = both.select("k", "other", (F.col("dot") / F.col("norm") / F.col("norm_b")).alias("cosine")).filter(F.col("cosine") >= least)
    return _members_of(near if digits is None else near.withColumn("cosine", F.round("cosine", digits)), members, "cosine")


# When two postings are the same.
SAME_TITLE, LIKE_TITLE, LIKE_TEXT, SAME_TEXT, SOME_TITLE = 0.85, 0.65, 0.60, 0.82, 0.40
#: Members of a block that one task compares at a time; a block's text similarity is fitted on all of it.
MOST_FEATURES = 1000


def _grams(text: str) -> Counter:
    import re

    words = re.findall(r"(?u)\b\w\w+\b", text.lower())
    return Counter(words) + Counter(map(" ".join, zip(words, words[1:], strict=False)))


def leaders(df: DataFrame, block: str, id_: str, title: str, text: str) -> DataFrame:
    """(id, leader): greedy groups in the order of ids; a leader takes all later unassigned rows that are the same as itself.

    Not transitive and dependent on order, so a block is one group of pandas; blocks are narrow (company and city)."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        n = len(pdf)
        counts = [_grams(f"{t or ''} {(x or '')[:500]}") for t, x in zip(pdf["title"], pdf["text"], strict=True)]
        total = Counter()
        for c in counts:
            total.update(c)
        kept = {g: i for i, (g, _) in enumerate(sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:MOST_FEATURES])}
        x = np.zeros((n, max(1, len(kept))))
        for i, c in enumerate(counts):
            for g, k in c.items():
                if g in kept:
                    x[i, kept[g]] = k
        x *= np.log((1 + n) / (1 + (x > 0).sum(axis=0))) + 1
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        words = [set(w) for w in pdf["words"]]
        leader = np.full(n, -1)
        for i in range(n):
            if leader[i] >= 0:
                continue
            leader[i] = i
            rest = np.flatnonzero(leader < 0)
            rest = rest[rest > i]
            texts = x[rest] @ x[i]
            for j, t in zip(rest, texts, strict=True):
                s = len(words[i] & words[j]) / len(words[i] | words[j]) if words[i] and words[j] else 0.0
                if s >= SAME_TITLE or (s >= LIKE_TITLE and t >= LIKE_TEXT) or (t >= SAME_TEXT and s >= SOME_TITLE):
                    leader[j] = i
        return pd.DataFrame({"id": pdf["id"], "leader": pdf["id"].to_numpy()[leader]})

    kind = dict(df.dtypes)[id_]
    rows = df.select(F.col(block).alias("block"), F.col(id_).alias("id"), F.col(title).alias("title"), F.substring(text, 1, 500).alias("text"), title_tokens(F.col(title)).alias("words"))
    return rows.groupBy("block").applyInPandas(group, f"id {kind}, leader {kind}")


def golden(df: DataFrame, group: str, id_: str) -> DataFrame:
    """One row a group from (salary_min_vnd, salary_max_vnd, salary_source, description, skills, benefits, source_platform).

    The best member leads; skills and benefits are united, a missing salary is taken from the best member that has one."""
    score = 50 * (F.coalesce(F.col("salary_max_vnd"), F.lit(0.0)) > 0).cast("double") + 30 * (F.coalesce(F.col("salary_min_vnd"), F.lit(0.0)) > 0).cast("double")
    score = score + F.least(F.length(F.coalesce("description", F.lit(""))) / 50, F.lit(40.0)) + F.least(5 * F.greatest(F.size(F.coalesce("skills", F.array().cast("array<string>"))), F.lit(0)), F.lit(30))
    row = F.struct((-score).alias("rank"), F.col(id_).alias("id"), "salary_min_vnd", "salary_max_vnd", "salary_source", "skills", "benefits", "source_platform")
    g = df.groupBy(group).agg(F.array_sort(F.collect_list(row)).alias("m"))
    none = F.array().cast("array<string>")
    unite = lambda field: F.aggregate("m", none, lambda acc, x: merge_ci(acc, x[field]))
    first = F.get("m", F.lit(0))
    paid = F.get(F.filter("m", lambda x: x["salary_min_vnd"].isNotNull() | x["salary_max_vnd"].isNotNull()), F.lit(0))
    own = first["salary_min_vnd"].isNotNull() | first["salary_max_vnd"].isNotNull()
    return g.select(
        first["id"].alias("id"), F.coalesce(F.when(own, first["salary_min_vnd"]), paid["salary_min_vnd"]).alias("salary_min_vnd"), F.coalesce(F.when(own, first["salary_max_vnd"]), paid["salary_max_vnd"]).alias("salary_max_vnd"),
        F.when(~own, paid["source_platform"]).alias("salary_source_fused"), unite("skills").alias("skills"), unite("benefits").alias("benefits"), F.size("m").cast("bigint").alias("duplicates"),
        F.transform("m", lambda x: x["id"]).alias("ids"), F.array_distinct(F.transform("m", lambda x: x["source_platform"])).alias("platforms"),
    )
