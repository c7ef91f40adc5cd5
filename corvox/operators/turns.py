"""Manifest records: turn accessors, rewrites, validation, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import numbered, running_total

TURN = "struct<from:string,type:string,value:string,duration:double,offset:double>"


def _of(turns: Column, who: str, kind: str, kind_default: str | None = None) -> Column:
    own = lambda t: F.coalesce(t["type"], F.lit(kind_default)) if kind_default else t["type"]
    return F.filter(turns, lambda t: (t["from"] == who) & (own(t) == kind))


def last_assistant_text(turns: Column, type_default: str | None = None) -> Column:
    """The value of the last text turn of the assistant, null if there is none."""
    return F.try_element_at(_of(turns, "Assistant", "text", type_default), F.lit(-1))["value"]


def first_assistant_text(turns: Column) -> Column:
    """The value of the first text turn of the assistant."""
    return F.get(_of(turns, "Assistant", "text"), F.lit(0))["value"]


def first_user_text(turns: Column, type_default: str | None = None) -> Column:
    """The prompt: the value of the first text turn of the user."""
    return F.get(_of(turns, "User", "text", type_default), F.lit(0))["value"]


def first_audio(turns: Column) -> Column:
    """The first audio turn, as a struct."""
    return F.get(F.filter(turns, lambda t: t["type"] == "audio"), F.lit(0))


def set_last_assistant_text(turns: Column, value: Column) -> Column:
    """The turns with the last text of the assistant replaced."""
    at = F.array_max(F.transform(turns, lambda t, i: F.when((t["from"] == "Assistant") & (t["type"] == "text"), i)))
    return F.transform(turns, lambda t, i: F.when(i == at, t.withField("value", value)).otherwise(t))


def prompt_first(turns: Column) -> Column:
    """The text turns of the user before all others, both in their order."""
    is_prompt = lambda t: (t["from"] == "User") & (t["type"] == "text")
    return F.concat(F.filter(turns, is_prompt), F.filter(turns, lambda t: ~is_prompt(t)))


def text_turn(who: str, value: Column) -> Column:
    """A text turn."""
    return F.struct(F.lit(who).alias("from"), F.lit("text").alias("type"), value.alias("value")).cast("struct<from:string,type:string,value:string>")


def with_prompt(turns: Column, prompt: Column) -> Column:
    """The turns behind a further prompt turn."""
    none = F.lit(None).cast("double")
    first = F.struct(F.lit("User").alias("from"), F.lit("text").alias("type"), prompt.alias("value"), none.alias("duration"), none.alias("offset"))
    return F.concat(F.array(first), turns)


def attach_prompt(turns: Column, prompt: Column) -> Column:
    """A prompt turn in front where the user says nothing yet."""
    return F.when(F.size(_of(turns, "User", "text")) > 0, turns).otherwise(with_prompt(turns, prompt))


def qa_record(rows: DataFrame, base: str, suffix: str, question: str, audio: str, duration: str, answer: str) -> DataFrame:
    """(id, conversations): question, audio and answer as a record of three turns."""
    turn = lambda who, kind, value, dur: F.struct(F.lit(who).alias("from"), F.lit(kind).alias("type"), value.alias("value"), dur.alias("duration"), F.lit(None).cast("double").alias("offset"))
    none = F.lit(None).cast("double")
    return rows.select(
        F.concat_ws("_", F.col(base).cast("string"), F.lit(suffix)).alias("id"),
        F.array(turn("User", "text", F.col(question), none), turn("User", "audio", F.col(audio), F.col(duration).cast("double")), turn("Assistant", "text", F.col(answer), none)).alias("conversations"),
    )


def valid(turns: Column) -> Column:
    """Whether all roles are known, the user begins, the assistant ends, and there is an assistant."""
    return (
        (F.size(turns) > 0)
        & F.forall(turns, lambda t: t["from"].isin("User", "Assistant"))
        & (F.get(turns, F.lit(0))["from"] == "User")
        & (F.try_element_at(turns, F.lit(-1))["from"] == "Assistant")
        & F.exists(turns, lambda t: t["from"] == "Assistant")
    )


def to_messages(turns: Column) -> Column:
    """Turns as messages of role and content."""
    return F.transform(
        turns,
        lambda t: F.struct(F.lower(t["from"]).alias("role"), F.array(F.struct(t["type"].alias("type"), F.when(t["type"] == "text", t["value"]).alias("text"), F.when(t["type"] == "audio", t["value"]).alias("path"))).alias("content")),
    )


def from_messages(messages: Column) -> Column:
    """Messages of role and content as turns."""
    none = F.lit(None).cast("double")
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.transform(m["content"], lambda c: F.struct(F.initcap(m["role"]).alias("from"), c["type"].alias("type"), F.coalesce(c["text"], c["path"]).alias("value"), none.alias("duration"), none.alias("offset"))),
        )
    )


def rewrite_by_template(turns: Column, user: str, answer: str) -> Column:
    """Text turns put into templates, in which {} stands for the text."""
    fill = lambda template, v: F.replace(F.lit(template), F.lit("{}"), v)
    return F.transform(
        turns,
        lambda t: F.when(t["type"] != "text", t).when(t["from"] == "User", t.withField("value", fill(user, t["value"]))).otherwise(t.withField("value", fill(answer, t["value"]))),
    )


def uniform(rows: DataFrame, id_col: str, fallback: Column, turns: str, language: str, extra: list[str]) -> DataFrame:
    """id, conversations, language, extra: the published shape; extra is the JSON of the other columns."""
    return rows.select(
        F.coalesce(F.nullif(F.col(id_col).cast("string"), F.lit("")), fallback).alias("id"), turns, F.col(language).alias("language"), F.to_json(F.struct(*extra)).alias("extra")
    )


def first_truthy(*columns: Column) -> Column:
    """The first value that is neither null, zero nor empty."""
    return F.coalesce(*columns)


def without_zero(c: Column) -> Column:
    """Null in the place of zero."""
    return F.when(c != 0, c)


def without_empty(c: Column) -> Column:
    """Null in the place of an empty text."""
    return F.when(c != "", c)


def rendered(turns: Column) -> Column:
    """One line for each turn: who, a colon, what."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["from"], F.lit(": "), t["value"])), "\n")


def matches_any(text: Column, patterns: list[str]) -> Column:
    """Whether a text holds one of the markers, such as those of anonymised names."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def without_garbage(text: Column, patterns: list[str]) -> Column:
    """The text without what matches; where something went, double blanks are one and none are at the ends."""
    bare = text
    for p in patterns:
        bare = F.regexp_replace(bare, p, "")
    return F.when(bare == text, text).otherwise(F.trim(F.regexp_replace(bare, " {2,}", " ")))


def without_questions(manifests: DataFrame, questions: DataFrame, question: str, item: str = "conv_id") -> DataFrame:
    """The records in which the user says none of the texts of a table, however many these are."""
    said = manifests.select(item, F.explode("conversations").alias("t")).where("t.from = 'User' and t.type = 'text'").select(item, F.col("t.value").alias(question))
    hit = said.join(questions.select(question).distinct(), question, "left_semi").select(item).distinct()
    return manifests.join(hit, item, "left_anti")


def asks_one_of(turns: Column, questions: list[str]) -> Column:
    """Whether the user says one of the given texts."""
    return F.exists(turns, lambda t: (t["from"] == "User") & (t["type"] == "text") & t["value"].isin(questions))


def detokenised(words: Column) -> Column:
    """Words (text, join) glued by their join: left, right, both or none."""
    start = F.struct(F.lit("").alias("text"), F.lit(True).alias("glue"))

    def add(acc: Column, w: Column) -> Column:
        left = F.coalesce(w["join"].isin("left", "both"), F.lit(False))
        right = F.coalesce(w["join"].isin("right", "both"), F.lit(False))
        gap = F.when(acc["glue"] | left, "").otherwise(" ")
        return F.struct(F.concat(acc["text"], gap, w["text"]).alias("text"), right.alias("glue"))

    return F.aggregate(words, start, add, lambda acc: acc["text"])


def path_language(path: Column, codes: list[str]) -> Column:
    """The last part of a path that is a language code."""
    return F.try_element_at(F.filter(F.split(path, "/"), lambda p: p.isin(codes)), F.lit(-1))


def rebased(path: Column, old: str, new: str) -> Column:
    """The path under a new base: relative to the old one, else by its last part."""
    return F.when(path.startswith(old), F.concat(F.lit(new), path.substr(F.lit(len(old) + 1), F.length(path)))).otherwise(F.concat(F.lit(new + "/"), F.substring_index(path, "/", -1)))


def best_suffix(rows: DataFrame, path: str, candidates: DataFrame, candidate: str) -> DataFrame:
    """(path, candidate): of the candidates with the same last part, the one that shares most last parts; then the smallest.

    The smallest candidate is found for each ending of one part, two parts and so on; a path meets it by its own endings
    and takes the longest. So rows grow with the parts of the paths, and no pairs of a common last part are tried.
    """

    def endings(c: str) -> Column:
        parts = F.sequence(F.lit(1), F.size(F.split(F.col(c), "/")))
        return F.inline(F.transform(parts, lambda k: F.struct(k.alias("__parts"), F.call_function("substring_index", F.col(c), F.lit("/"), -k).alias("__ending"))))

    best = candidates.select(candidate, endings(candidate)).groupBy("__ending").agg(F.min(candidate).alias(candidate))
    own = rows.select(path).distinct().select(path, endings(path))
    return own.join(best, "__ending").groupBy(path).agg(F.max_by(candidate, "__parts").alias(candidate))


def drawn_pairs(rows: DataFrame, group: str, item: str, draw: Column) -> DataFrame:
    """(group, first_id, second_id): the items of each group paired off in the order of a uniform draw; an odd one is left.

    Places are counted in buckets of the draw, and the two of a pair meet by equality, so no task holds a group.
    """
    placed = numbered(rows.select(group, item, draw.alias("__draw")), [group], F.col("__draw"), [item], "__r")
    pair = placed.withColumn("__pair", F.floor(F.col("__r") / 2))
    first = pair.where("__r % 2 = 0").select(group, "__pair", F.col(item).alias("first_id"))
    return first.join(pair.where("__r % 2 = 1").select(group, "__pair", F.col(item).alias("second_id")), [group, "__pair"]).drop("__pair")


def best_of(rows: DataFrame, keys: list[str], order: list[Column], k: int, item: Column, parts: int = 64) -> DataFrame:
    """The first k rows of each group in an order: first of each part of a group, by a hash of the item, then of those."""
    rank = lambda *own: F.row_number().over(Window.partitionBy(*own).orderBy(*order))
    some = rows.withColumn("__part", F.pmod(F.xxhash64(item), F.lit(parts))).withColumn("__r", rank(*keys, "__part")).where(F.col("__r") <= k)
    return some.withColumn("__r", rank(*keys)).where(F.col("__r") <= k).drop("__r", "__part")


def spread_chunks(rows: DataFrame, group: str, answer: str, order: list[str], bucket: Column, size: int) -> DataFrame:
    """rows with `chunk`: those of a group in chunks of `size`, the first of each answer before the second of any.

    Places among equal answers and in the group are counted in buckets (`bucket` must not fall along the order).
    """
    nth = running_total(rows, [group, answer], bucket, order, None, "__k")
    placed = running_total(nth, [group], F.floor(F.col("__k") / 1000), ["__k", answer, *order[-1:]], None, "__place")
    return placed.withColumn("chunk", F.floor(F.col("__place") / size)).drop("__k", "__place")
