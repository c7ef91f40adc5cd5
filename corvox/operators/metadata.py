"""Metadata of records: usable labels, keys in names, licences by path, prompts by session, and the filters on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The age groups that have a wording. Fixed values.
AGES = ("teens", "twenties", "thirties", "fourties", "fifties", "sixties", "seventies", "eighties", "nineties")


def usable_age(raw: Column) -> Column:
    """The age group, in lower case; empty where it has no wording."""
    said = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.when(said.isin(*AGES), said).otherwise("")


def usable_accent(raw: Column) -> Column:
    """The first of accents with commas between them; empty if it has fewer than four characters, as cut-off ones do."""
    first = F.trim(F.get(F.split(F.coalesce(raw, F.lit("")), ","), F.lit(0)))
    return F.when(F.length(first) >= 4, first).otherwise("")


def council_key(uid: Column) -> Column:
    """(city, date, item) of ids like TownCouncil_01022020_X-1; null where an id has another form."""
    form = r"^([A-Za-z]+?)(?:CityCouncil|Council)_(\d{6,8})_(.+)$"
    part = lambda k: F.regexp_extract(uid, form, k)
    return F.when(uid.rlike(form), F.struct(part(1).alias("city"), part(2).alias("date"), part(3).alias("item")))


def meeting_audio(items: DataFrame, files: DataFrame, uid: str = "uid") -> DataFrame:
    """items with `audio`: the first path of files(city, path) of the city whose name holds the date of the uid, or null.

    Dates are cut out of the names, so items and files meet by equality; a name with several dates stands for each.
    """
    keyed = items.withColumn("__k", council_key(F.col(uid))).withColumns({"__city": F.col("__k.city"), "__date": F.col("__k.date")})
    name = F.substring_index("path", "/", -1)
    # All runs of six to eight digits of a name, at each place: what a search for the date in the name would find.
    digits = F.flatten(F.transform(F.regexp_extract_all(name, F.lit(r"(\d{6,})"), 1), lambda r: F.flatten(F.transform(F.sequence(F.lit(6), F.lit(8)), lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.length(r)), lambda i: i + n - 1 <= F.length(r)), lambda i: F.substring(r, i, n))))))
    dated = files.select(F.col("city").alias("__city"), "path", F.explode(F.array_distinct(digits)).alias("__date"))
    first = dated.groupBy("__city", "__date").agg(F.min("path").alias("audio"))
    return keyed.join(first, ["__city", "__date"], "left").drop("__k", "__city", "__date")


def policy(path: Column, registry: Sequence[tuple[str, str]], default: str) -> Column:
    """The licence of a path: that of the longest pattern of the registry that it holds, in any case, or the default.

    registry: (pattern, licence), a configuration's list; of patterns of one length the first counts.
    """
    out = F.lit(default)
    # The last condition that is put around the others is asked first: the longest pattern, the first of its length.
    for pattern, licence in sorted(reversed([e for e in registry if e[0]]), key=lambda e: len(e[0])):
        out = F.when(F.contains(F.lower(path), F.lit(pattern.lower())), F.lit(licence)).otherwise(out)
    return out


def with_prompts(segments: DataFrame, prompts: DataFrame) -> DataFrame:
    """segments(session, utterance, ...) with `prompt` from prompts(key, text), keys like session/.../utterance; or null."""
    keyed = prompts.select(F.substring_index("key", "/", 1).alias("session"), F.substring_index("key", "/", -1).alias("utterance"), F.col("text").alias("prompt"))
    return segments.join(keyed, ["session", "utterance"], "left")


def at_least(rows: DataFrame, column: str, least: float) -> DataFrame:
    """The rows with so much of a column, such as a talk's duration; without a value a row goes."""
    return rows.where(F.col(column) >= least)


def no_longer(rows: DataFrame, text: str, most: int = 300) -> DataFrame:
    """The rows whose text, such as a question, has at most so many characters; one without a text goes."""
    return rows.where(F.length(text) <= most)


def with_metadata(rows: DataFrame, column: str) -> DataFrame:
    """The rows whose list has an entry that isn't blank."""
    return rows.where(F.exists(column, lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""))


def of_datasets(rows: DataFrame, column: str, wanted: Sequence[str | int]) -> DataFrame:
    """The rows of the wanted datasets: by name, or by their number from 0 in the order of all names."""
    names = rows.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = names.withColumn("__n", F.row_number().over(Window.orderBy(column)) - 1)
    own, numbers = [w for w in wanted if isinstance(w, str)], [w for w in wanted if not isinstance(w, str)]
    kept = numbered.where(F.col(column).isin(*own) | F.col("__n").isin(*numbers)).select(column)
    return rows.join(kept, column, "left_semi")
