"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regex is parsed into a Boolean trigram query: an OR of ANDs of trigrams (lower case) that every match must
hold. The index lists, for each trigram that some rule asks for, the rows that hold it. Postings of a query's trigrams
are intersected by counting them per row; only candidates are verified with the regex. A rule without mandatory
trigrams scans every row. Up to MOST_SENT candidates (counted) are sent to the texts; beyond, both are dealt by id.

Cases: a null or empty text has no spans; rows with a null id are scanned in full, since postings can't tell them apart; rows
that repeat an id keep a row each (verification runs per row, so postings that rows of one id share only add candidates), and
an id with a third of all rows is several tasks; a very long text is verified as any other, in time that grows with its
length; an empty table gives an empty result; extra columns are not read.
Positions are code points, ends exclusive; matches of one rule are leftmost and do not overlap.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm.common import SALTS, materialize, table

#: Candidates up to so many rows (counted) are broadcast.
MOST_SENT = 200_000
#: Matches that one array takes up at a time.
RUN = 256
#: Characters that Unicode keeps free for use within a program.
MARKS = "\ufdd0\ufdd1\ufdd2"


@dataclass(frozen=True)
class Rule:
    """pattern: the same in Java, Python and RE2; group and least: the part whose length is tested, and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The base kinds, in the order of their listing.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),  # maximal runs, so those of [0-9a-f]+ with 16 or more
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES

#: A class or alternation with more literal forms than this counts as "any text".
MOST_FORMS = 16


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The pattern as an OR of trigram sets, each to be held whole; [] if some match needs no trigram.

    Walks Python's parse of the pattern and keeps, for a sequence, the literal strings that it can spell between parts
    that can be anything; each run of three or more characters gives its trigrams."""
    import re._constants as k
    import re._parser as parser

    def forms(items) -> list[list[str | None]]:
        """Alternatives, each a list of characters where None stands for any text."""
        out: list[list[str | None]] = [[]]
        for op, arg in items:
            if op is k.LITERAL:
                more = [[chr(arg).lower()]]
            elif op is k.IN:
                chars = {chr(a).lower() for o, a in arg if o is k.LITERAL}
                fixed = all(o is k.LITERAL for o, _ in arg) and len(chars) <= MOST_FORMS
                more = [[c] for c in sorted(chars)] if fixed else [[None]]
            elif op is k.SUBPATTERN:
                more = forms(arg[3])
            elif op is k.BRANCH:
                more = [f for branch in arg[1] for f in forms(branch)]
            elif op is k.MAX_REPEAT and (arg[0], arg[1]) == (0, 1):
                more = [[], *forms(arg[2])]
            elif op is k.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 8:
                more = [list(itertools.chain(*p)) for p in itertools.product(forms(arg[2]), repeat=int(arg[0]))]
            else:
                more = [[None]]
            if len(out) * len(more) > 4 * MOST_FORMS:
                more = [[None]]
            out = [a + b for a in out for b in more]
        return out

    queries = []
    for form in forms(parser.parse(pattern)):
        runs = "".join("\n\n\n" if c is None else c for c in form).split("\n\n\n")
        found = frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2))
        if not found:
            return []
        queries.append(found)
    least = {q for q in queries if not any(p < q for p in queries)}
    return sorted(least, key=sorted)


def index(docs: DataFrame, trigrams: list[str], text: str, key: str) -> DataFrame:
    """Postings (trigram, key): for each of the given trigrams the rows whose lower-case text holds it."""
    # every trigram of the text made of characters that some asked trigram uses, from a lookahead at each position
    chars = "".join("\\" + c if not c.isalnum() else c for c in sorted(set("".join(trigrams))))
    held = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"(?=([{chars}]{{3}}))"), F.lit(1))
    asked = F.array(*[F.lit(t) for t in trigrams])
    return docs.select(key, F.explode(F.array_intersect(asked, held)).alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...], key: str) -> DataFrame:
    """(key, kinds): the rules whose trigram query the row satisfies. Rules without a query are not listed."""
    # one row of postings per row id: counts per (rule, alternative) are then a fold over a few literals
    held = postings.groupBy(key).agg(F.collect_set("trigram").alias("held"))
    met = []
    for r in rules:
        if qs := trigram_query(r.pattern):
            test = reduce(lambda a, b: a | b, [F.size(F.array_intersect("held", F.array(*[F.lit(t) for t in sorted(q)]))) == len(q) for q in qs])
            met.append(F.when(test, F.lit(r.kind)))
    return held.select(key, F.array_compact(F.array(*met)).alias("kinds")).filter(F.size("kinds") > 0)


def _prefix(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Of an array, for each place what step makes of zero and all values before; in runs of RUN, so that no array grows by
    one element as often as a text has matches."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / RUN), F.lit(0)).cast("int")), lambda c: F.slice(values, c * RUN + 1, F.lit(RUN)))
    more = lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))
    starts = F.aggregate(runs, F.array(zero), lambda acc, r: F.concat(acc, F.array(F.aggregate(r, F.element_at(acc, -1), step))))
    return F.flatten(F.transform(runs, lambda r, i: F.slice(F.aggregate(r, F.array(F.get(starts, i)), more), 1, F.size(r))))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start, rank, end, kind>> of a rule's matches: one pass of the regex puts marks around each match and its
    tested part, and the lengths between marks give the places. Texts that hold a mark themselves take the plain way."""
    a, b, c = MARKS
    pattern = F.lit(rule.pattern)
    pieces = F.split(F.regexp_replace(text, pattern, F.lit(f"{a}$0{b}" + (f"${rule.group}" if rule.group else "") + c)), a)
    at = lambda p, mark: F.instr(p, mark)
    marked = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            (at(p, b) - 1).alias("len"),
            ((at(p, c) - at(p, b) - 1) if rule.group else (at(p, b) - 1)).alias("tested"),
            (at(p, b) - 1 + F.length(p) - at(p, c)).alias("step"),  # the match and what follows it
        ),
    )
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    plain = F.transform(F.arrays_zip(found.alias("f"), tested.alias("t"), F.slice(between, 2, F.size(found)).alias("g")), lambda p: F.struct(F.length(p["f"]).alias("len"), F.length(p["t"]).alias("tested"), (F.length(p["f"]) + F.length(p["g"])).alias("step")))
    odd = text.rlike(f"[{a}{b}{c}]")
    first = F.when(odd, F.length(F.get(between, F.lit(0)))).otherwise(F.length(F.get(pieces, F.lit(0))))
    parts = F.when(odd, plain).otherwise(marked)

    def placed(x: Column) -> Column:
        starts = _prefix(F.transform(x["parts"], lambda p: p["step"]), x["first"], lambda u, v: u + v)
        both = F.filter(F.zip_with(starts, x["parts"], lambda s, p: F.struct(s.alias("s"), p.alias("p"))), lambda z: z["p"]["tested"] >= rule.least)
        return F.transform(both, lambda z: F.struct(z["s"].alias("start"), F.lit(rank).alias("rank"), (z["s"] + z["p"]["len"]).alias("end"), F.lit(rule.kind).alias("kind")))

    # worked out once a row
    return F.get(F.transform(F.array(F.struct(first.alias("first"), parts.alias("parts"))), lambda x: F.when(F.size(x["parts"]) > 0, placed(x))), F.lit(0))


def _with_kinds(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (row, text, key) with the kinds that found (found, kinds) has for their key; rows without a key: all kinds."""
    found = materialize(found, "candidates")
    if found.count() <= MOST_SENT:
        return rows.join(F.broadcast(found), F.col("key") == F.col("found"), "left")
    salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
    spread = found.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    keyed = rows.filter("key is not null").withColumn("_salt", salt).join(spread, (F.col("key") == F.col("found")) & (F.col("_salt") == F.col("_s")), "left").drop("_salt", "_s")
    return keyed.unionByName(rows.filter("key is null"), allowMissingColumns=True)


def _scanned(docs: DataFrame, rules: tuple[Rule, ...], text: str, key: str) -> DataFrame:
    """(row: all columns of docs, text, spans). A row's own columns stand in a struct, so no name can clash."""
    queried = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = sorted({t for qs in queried.values() for q in qs for t in q})
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.col(key).alias("key"))
    if asked:
        rows = _with_kinds(rows, candidates(index(docs.filter(F.col(key).isNotNull()), asked, text, key), rules, key).select(F.col(key).alias("found"), "kinds"))
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    of_rules = []
    for rank, r in enumerate(rules):
        spans = _spans(F.col("text"), r, rank)
        of_rules.append(F.coalesce(F.when(F.array_contains("kinds", r.kind) | F.col("key").isNull(), spans) if queried[r.kind] else spans, none))
    return rows.select("row", "text", F.array_sort(F.concat(*of_rules)).alias("spans"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with a column spans (which replaces one of that name): array<struct<start, rank, end, kind>> ordered by start, then
    by the rule's rank; never null."""
    own = [c for c in docs.columns if c != "spans"]
    return _scanned(docs, rules, text, key).select(*[F.col("row").getField(c).alias(c) for c in own], "spans")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with each span of a secret replaced by [KIND]; overlapping spans are replaced once, under the first's kind."""
    past = _prefix(F.transform("spans", lambda x: x["end"]), F.lit(0), lambda u, v: F.greatest(u, v))  # where all spans before have ended
    kept = F.filter(F.zip_with("spans", past, lambda x, e: F.struct(x.alias("x"), e.alias("e"))), lambda z: z["x"]["start"] >= z["e"])
    parts = F.transform(kept, lambda z: F.concat(F.substring(F.col("text"), z["e"] + 1, z["x"]["start"] - z["e"]), F.lit("["), F.upper(z["x"]["kind"]), F.lit("]")))
    last = F.array_max(F.transform("spans", lambda x: x["end"]))
    pieces = F.concat(F.array_join(parts, ""), F.substring(F.col("text"), last + 1, F.length("text")))
    out = F.when(F.size("spans") > 0, pieces).otherwise(F.col("text"))
    return _scanned(docs, rules, text, key).select(*[out.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents: counts of the base kinds, a digest of their spans, and all spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *[n(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def oracle() -> str:
    """The same in DuckDB: positions from the lengths of what stands between and in the matches."""

    def spans(rank: int, r: Rule) -> str:
        p = r.pattern.replace("'", "''")
        return f"""select doc_id, {rank} as rank, '{r.kind}' as kind, unnest(list_transform(range(1, len(found) + 1), lambda i: {{
            's': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i-1], lambda g: length(g))), 0),
            'len': length(found[i]), 'ok': length(tested[i]) >= {r.least}}})) as x
        from (select doc_id, string_split_regex(text, '{p}') as gaps, regexp_extract_all(text, '{p}') as found, regexp_extract_all(text, '{p}', {r.group}) as tested
              from documents where regexp_matches(text, '{p}'))"""

    all_spans = "\nunion all\n".join(spans(i, r) for i, r in enumerate(RULES))
    counts = ", ".join(f"coalesce(count(*) filter (where kind = '{r.kind}'), 0) as n_{r.kind}" for r in BASE_RULES)
    return f"""with spans as (select doc_id, rank, kind, x.s::bigint as s, (x.s + x.len)::bigint as e from ({all_spans}) where x.ok),
    per as (select doc_id, {counts},
        string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (where rank < {len(BASE_RULES)}) as base,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from spans group by doc_id)
    select d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in BASE_RULES)},
        sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from documents d left join per using (doc_id)"""
