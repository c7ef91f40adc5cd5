"""Preference formatting of chosen and rejected conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hex_buckets, running_total

#: How a turn is written, and whose turns count for the loss.
OPEN, MIDDLE, CLOSE, LEARNED = "<|", "|>\n", "<|end|>\n", "assistant"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): each conversation's turns as structs (role, text), in the order of their numbers.

    Null roles and texts count as empty. Turns of one number follow the order of role and text, null numbers first.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return turns.groupBy(F.col(conv).alias("conv")).agg(
        F.transform(F.array_sort(F.collect_list(one)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def shared_turns(a: Column, b: Column) -> Column:
    """How many turns, from the first on, are the same in both arrays."""
    differ = F.filter(
        F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda t, i: F.when(t["a"].eqNullSafe(t["b"]), F.lit(None)).otherwise(i)),
        lambda i: i.isNotNull(),
    )
    return F.coalesce(F.get(differ, F.lit(0)), F.least(F.size(a), F.size(b)))


def rendered(turns: Column) -> Column:
    """The turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def learned_spans(turns: Column) -> Column:
    """[start, end) of what counts for the loss in the rendered turns: the assistant's texts with their closing mark."""
    head = lambda t: F.length(t["role"]) + len(OPEN) + len(MIDDLE)
    body = lambda t: F.length(t["text"]) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + head(t)
        end = begin + body(t)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        more = F.when(t["role"] == LEARNED, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def formatted(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """pairs with prefix_turns, prompt, and of both sides completion and learned spans; columns so named are replaced.

    The longest common prefix of turns is the prompt, rendered once; what follows on each side is its completion.
    Prompt text never counts for the loss. Of two equal conversations all is prompt, and both completions are empty;
    a null side has no turns.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    n = F.col("prefix_turns")
    rest = lambda x: F.slice(x, n + 1, F.greatest(F.size(x) - n, F.lit(0)))
    return (
        pairs.withColumn("prefix_turns", shared_turns(a, b))
        .withColumn("prompt", rendered(F.slice(a, F.lit(1), n)))
        .withColumn("chosen_completion", rendered(rest(a)))
        .withColumn("chosen_spans", learned_spans(rest(a)))
        .withColumn("rejected_completion", rendered(rest(b)))
        .withColumn("rejected_spans", learned_spans(rest(b)))
    )


def paired(convs: DataFrame, count: int) -> DataFrame:
    """(opening, pair, chosen_id, chosen, rejected_id, rejected): conversations with the same first turn, two by two.

    Inside an opening the conversations stand in the order of a hash of their id; the first of two is taken as chosen,
    and the last of an odd number has no partner. A null conv is a conversation like others. Of convs only the columns
    conv and turns are read, so others can't clash; an empty table gives no rows. However many share an opening, places are counted in buckets, and
    each pair is put together by its own key.
    """
    first = F.get("turns", F.lit(0))
    told = F.concat_ws(":", F.length(first["role"]), first["role"], first["text"])  # the length keeps role and text apart
    keyed = convs.select("conv", "turns", F.md5(told).alias("opening"))
    keyed = keyed.withColumn("__hash", F.md5(F.concat(F.lit("pair:"), F.coalesce(F.col("conv").cast("string"), F.lit("")))))
    placed = running_total(keyed, ["opening"], hex_buckets("__hash", count), ["__hash", "conv"], None, "__place")
    side = F.pmod("__place", F.lit(2))
    return placed.groupBy("opening", F.floor(F.col("__place") / 2).alias("pair")).agg(
        F.max(F.when(side == 0, F.col("conv"))).alias("chosen_id"),
        F.first(F.when(side == 0, F.col("turns")), ignorenulls=True).alias("chosen"),
        F.max(F.when(side == 1, F.col("conv"))).alias("rejected_id"),
        F.first(F.when(side == 1, F.col("turns")), ignorenulls=True).alias("rejected"),
    )
