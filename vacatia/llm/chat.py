"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as
named users; the mask covers what the assistant says (with the end mark), so each speaker's turns are learnt once.
System turns keep their role in every perspective and are never learnt.

A dialogue is rendered in parts of at most PART turns, so that no group grows with a conversation's length; part gives the
order, and the parts' texts put one after the other are the whole dialogue. Turns stand by (turn, role, text). Turns are
numbered by sorting ranges of them, so that a conversation with a third of all rows, or that many turns of one number, is
several tasks.

Cases: repeated rows are one turn; turns of one number stand by role, then text; a null text is empty, a null or empty role
is the speaker "unknown", a null turn comes first, a null conv_id is a conversation of its own; a conversation of
system turns alone has no participant and no row; a very long text is one turn as any other; an empty table gives an empty
result; extra columns are not read. "<|" in a text or name is written "< |", so a text can't end its own turn; a line break
in a name is written as \\n in the turn's head, so a name can't either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacatia.llm.common import SALTS, materialize, table

PART = 256
SYSTEM = "system"
# The marks of a turn.
START, END = "<|im_start|>", "<|im_end|>\n"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def numbered(rows: DataFrame) -> DataFrame:
    """rows (_conv, _turn, _role, _text), which are distinct, with _n: a turn's place in its conversation, from 0."""
    order = ["_conv", "_turn", "_role", "_text"]
    at = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "turns")
    # a conversation lies in one run of rows of each range that has any of it
    runs = at.groupBy("_conv", F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(W.partitionBy("_conv").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("_conv").alias("_c"), F.col("_range").alias("_r"), "_first", before.alias("_before"))
    j = at.withColumn("_range", F.shiftright("_at", 33)).join(runs, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r")))
    return j.select(*order, (F.col("_at") - F.col("_first") + F.col("_before")).alias("_n"))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, speaker, part, n_turns, rendered, mask): mask is array<struct<start, end>> in code points of rendered."""
    speaker = F.coalesce(F.when(F.col(role) != "", F.col(role)), F.lit("unknown"))
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), _safe(speaker).alias("_role"), _safe(F.coalesce(F.col(text), F.lit(""))).alias("_text")).distinct()
    rows = numbered(rows).withColumn("_part", F.floor(F.col("_n") / PART).cast("long"))
    parts = rows.groupBy("_conv", "_part").agg(F.array_sort(F.collect_list(F.struct(F.col("_n").alias("n"), F.col("_role").alias("r"), F.col("_text").alias("x")))).alias("turns"))
    parts = parts.withColumn("_salt", F.pmod("_part", F.lit(SALTS)))
    # speakers go to as many places as their conversation has parts, up to SALTS
    who = rows.filter(F.col("_role") != SYSTEM).select("_conv", F.col("_role").alias("speaker")).distinct()
    longest = rows.groupBy("_conv").agg(F.max("_part").alias("_last")).select(F.col("_conv").alias("_c"), "_last")
    who = who.join(longest, F.col("_conv").eqNullSafe(F.col("_c"))).select(F.col("_conv").alias("_c"), "speaker", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_last"), F.lit(SALTS - 1)))).alias("_s"))
    both = parts.join(who, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_salt") == F.col("_s")))

    name = lambda r: F.replace(F.replace(r, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    head = lambda r: F.when(r == F.col("speaker"), F.lit("assistant")).when(r == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), name(r)))
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), head(t["r"]), F.lit("\n")).alias("head"), F.concat(t["x"], F.lit(END)).alias("body"), (t["r"] == F.col("speaker")).alias("own")))
    both = both.withColumn("pieces", pieces)
    spans = F.array().cast("array<struct<start:int,end:int>>")
    mask = F.aggregate(  # at most PART turns
        "pieces",
        F.struct(F.lit(0).alias("at"), spans.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(p["own"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    rendered = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    return both.select(F.col("_conv").alias(conv), "speaker", F.col("_part").alias("part"), F.size("turns").alias("n_turns"), rendered.alias("rendered"), mask.alias("mask"))


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective."""
    out = rotate(table(spark, sf_dir, "conversations"))
    return out.withColumn("mask", F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ","))


def oracle() -> str:
    s = lambda c: f"replace({c}, '<|', '< |')"
    return f"""with d as (select distinct conv_id, turn, {s("coalesce(nullif(role, ''), 'unknown')")} as role, {s("coalesce(text, '')")} as text from conversations),
    t as (select *, ((row_number() over (partition by conv_id order by turn nulls first, role, text) - 1) // {PART})::bigint as part from d),
    who as (select distinct conv_id, role as speaker from t where role <> '{SYSTEM}'),
    p as (select t.conv_id, speaker, part, turn, role, text,
        '{START}' || case when role = speaker then 'assistant' when role = '{SYSTEM}' then '{SYSTEM}' else 'user name=' || replace(replace(role, chr(13), '\\r'), chr(10), '\\n') end || chr(10) as head, text || '{END.strip()}' || chr(10) as body
        from t join who on t.conv_id is not distinct from who.conv_id),
    o as (select *, sum(length(head) + length(body)) over (partition by conv_id, speaker, part order by turn nulls first, role, text) as past from p)
    select conv_id, speaker, part, count(*)::int as n_turns, string_agg(head || body, '' order by turn nulls first, role, text) as rendered,
        coalesce(string_agg((past - length(body))::bigint || ':' || past::bigint, ',' order by turn nulls first, role, text) filter (where role = speaker), '') as mask
    from o group by all"""
