"""Preference pairs: one prompt of shared turns and two completions with masks.

The longest run of first turns that a chosen and a rejected conversation have in common (role and
text) is rendered once as the prompt. The turns after it are rendered as two completions, each with the
stretches of characters that are to be learned: what the assistant says, with its end mark.

Turns are numbered by sums over stretches of turn numbers and the two sides meet turn by turn, so a conversation of any length is
spread over tasks. ``preference_turns`` gives the rendered turns as rows; ``format_preferences`` joins those of a pair
to texts, up to a stated size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.llm.hot import join_classes
from commentloom.llm.scratch import numbered, stored
from commentloom.operators.running import running_total

LEARNED_ROLE = "assistant"
HEAD, TAIL, END = "<|", "|>\n", "<|end|>\n"
PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"
# Turn numbers that one task orders.
STRETCH = 1024
# Characters of a pair that are joined to texts in one row.
MOST_CHARS = 1 << 27


def _tie() -> Column:
    """What settles the order of equal turn numbers, and tells turns apart: role and a digest of the text."""
    return F.struct(F.coalesce("role", F.lit("")).alias("role"), F.md5(F.coalesce("text", F.lit(""))).alias("text"))


def global_rank(df: DataFrame, by: str, into: str) -> DataFrame:
    """The place of each row in the order of a column, from 0; ties in any order."""
    ordered = stored(numbered(df.orderBy(by), "_at"), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    # One row per task of the sort.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn(into, F.col("_before") + F.expr("_at & 8589934591"))
        .select(*df.columns, into)
    )


def swapped_replies(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns (pair_id, turn, role, text and the columns to carry) made from plain conversations.

    Chosen is the conversation as it is; rejected is the same up to its last reply, and then the last reply
    of another conversation: those that have a reply go together two by two in the order of their ids, and an odd last one takes
    the first one's. Conversations without a reply or an id give no pair, nor does a single one. Turns are taken in the order of
    ``preference_turns``; repeated rows are turns of their own.
    """
    named = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("pair_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"), *carry
    )
    place = F.struct("turn", _tie().alias("tie"))
    kept = F.struct(place.alias("place"), "role", "text", *carry)
    replies = (
        named.groupBy("pair_id")
        .agg(F.max(F.when(F.col("role") == LEARNED_ROLE, kept)).alias("_reply"), F.count(F.lit(1)).alias("_turns"))
        .where("_reply IS NOT NULL")
    )
    ranked = stored(global_rank(replies, "pair_id", "_rank"), "replies")
    count = ranked.count()
    partner = F.expr("_rank ^ 1")
    asked = ranked.withColumn("_partner", F.when(partner < count, partner).otherwise(F.lit(0))).where("_partner <> _rank")
    other = ranked.select(F.col("_rank").alias("_partner"), F.col("_reply").alias("_other"))
    both = stored(asked.join(other, "_partner").select("pair_id", "_reply", "_other", "_turns"), "pairs")
    chosen = join_classes(named, both.select("pair_id", "_reply.place", "_turns"), "pair_id", "_turns")
    upto = chosen.withColumn("_place", place).where("_place <= place")
    # Of equal last replies one is replaced.
    again = (
        upto.where("_place = place").groupBy("pair_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").join(both, "pair_id")
    ).select("pair_id", "_reply", F.explode(F.expr("sequence(2L, _n)")))
    columns = ["pair_id", "turn", "role", "text", *carry]

    def from_reply(reply: str) -> list[Column]:
        return ["pair_id", F.col("_reply.place.turn").alias("turn"), *[F.col(f"{reply}.{c}").alias(c) for c in columns[2:]]]

    before = upto.where("_place < place").select(*columns)
    rejected = before.union(again.select(*from_reply("_reply"))).union(both.select(*from_reply("_other")))
    return chosen.select(*columns), rejected


def preference_turns(chosen: DataFrame, rejected: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """pair_id, prompt_turns, part, place, turn, role, text and the columns to carry of each turn of each pair.

    Both tables have pair_id, turn, role and text. ``part`` is prompt, chosen or rejected, and ``place`` counts the turns of
    the conversation from 0. The prompt's turns come once. Turns are taken in order of ``turn``, a NULL number
    first, ties by role and a digest of the text; a NULL role or text counts as empty. Repeated rows are turns of their own. A
    pair with turns on one side only, or without id, gives no row. Other columns than those to carry are not looked at.
    """
    columns = ["pair_id", "turn", "role", "text", *carry]
    sides = [
        side.where(F.col("pair_id").isNotNull()).select(*columns, F.lit(name).alias("side"))
        for side, name in ((chosen, CHOSEN), (rejected, REJECTED))
    ]
    whole = sides[0].union(sides[1]).withColumn("_tie", _tie())
    stretch = F.coalesce(F.expr(f"floor(turn / {STRETCH})"), F.lit(-(1 << 62))).cast("long")
    # NULL numbers sort first, as they lie in the lowest stretch.
    placed = stored(
        running_total(whole.withColumn("_stretch", stretch), ["pair_id", "side"], "_stretch", ["turn", "_tie"], F.lit(1), "place").drop("_stretch"),
        "turns",
    )
    met = placed.groupBy("pair_id", "place").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_tie").alias("_low"), F.max("_tie").alias("_high"),
        F.count_if(F.col("side") == CHOSEN).alias("_chosen"),
    )
    differs = (F.col("_n") == 1) | (F.col("_low") != F.col("_high"))
    shared = met.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(differs, F.col("place"))), F.max("place") + 1).alias("prompt_turns"),
        F.sum("_n").alias("_turns"), F.sum("_chosen").alias("_chosen"),
    ).where("_chosen > 0 AND _chosen < _turns").drop("_chosen")
    in_prompt = F.col("place") < F.col("prompt_turns")
    return (
        join_classes(placed, shared, "pair_id", "_turns")
        .where(~in_prompt | (F.col("side") == CHOSEN))
        .select("pair_id", "prompt_turns", F.when(in_prompt, F.lit(PROMPT)).otherwise(F.col("side")).alias("part"), "place", *columns[1:])
    )


def rendered_chars(role: Column, chars: Column) -> Column:
    """Characters of a rendered turn whose text has so many."""
    return F.length(F.coalesce(role, F.lit(""))) + chars + len(HEAD) + len(TAIL) + len(END)


def learned_chars(role: Column, chars: Column) -> Column:
    """Of these, the characters that are learned: an assistant's text and its end mark."""
    return F.when(role == LEARNED_ROLE, chars + len(END)).otherwise(F.lit(0))


def format_preferences(chosen: DataFrame, rejected: DataFrame, most_chars: int = MOST_CHARS) -> DataFrame:
    """pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask and rejected_mask of each pair.

    Masks are arrays of (start, end) in characters of the completion; a completion is empty if one conversation begins the other. Cases
    as in ``preference_turns``. The texts of a pair of more than ``most_chars`` characters are NULL: such a pair is to be
    taken turn by turn from there.
    """
    return render_preferences(preference_turns(chosen, rejected), most_chars)


def render_preferences(turns: DataFrame, most_chars: int = MOST_CHARS) -> DataFrame:
    """The rows of ``format_preferences`` from those of ``preference_turns``."""
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    sizes = turns.groupBy("pair_id", "prompt_turns").agg(F.sum(rendered_chars(F.col("role"), chars)).alias("_chars"))
    fits = sizes.where(F.col("_chars") <= most_chars).select("pair_id")
    one = F.struct("part", "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = turns.join(fits, "pair_id", "left_semi").groupBy("pair_id").agg(F.array_sort(F.collect_list(one)).alias("_all"))
    texts = gathered.selectExpr(
        "pair_id", *[f"filter(_all, t -> t.part = '{p}') AS _{p}" for p in (PROMPT, CHOSEN, REJECTED)]
    ).select(
        "pair_id",
        *[_rendered(f"_{p}").alias(p) for p in (PROMPT, CHOSEN, REJECTED)],
        *[_mask(f"_{p}").alias(f"{p}_mask") for p in (CHOSEN, REJECTED)],
    )
    return sizes.select("pair_id", F.col("prompt_turns").cast("long")).join(texts, "pair_id", "left")


def _rendered(turns: str) -> Column:
    one = lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(TAIL), t["text"], F.lit(END))
    return F.array_join(F.transform(turns, one), "")


def _mask(turns: str) -> Column:
    """(start, end) of what the assistant says, end mark included."""
    kind = "array<struct<start: bigint, end: bigint>>"
    head = lambda t: F.lit(len(HEAD) + len(TAIL)) + F.length(t["role"])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("spans"))

    def add(state, t):
        first = state["at"] + head(t)
        last = first + F.length(t["text"]) + len(END)
        span = F.struct(first.cast("bigint").alias("start"), last.cast("bigint").alias("end"))
        spans = F.when(t["role"] == LEARNED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(last.cast("bigint").alias("at"), spans.cast(kind).alias("spans"))

    return F.aggregate(turns, start, add, lambda s: s["spans"])
