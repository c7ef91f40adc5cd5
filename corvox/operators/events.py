"""Transcripts with events: ordered items of texts, speakers, events and comments, rendered as the text of a window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timeline import binned

#: Codes of sounds and what descriptions of sounds hold, with the tag of each (None: no sound of its own). Fixed values.
SOUND_CODES = {
    "r": "breath", "i": "breath", "e": "breath", "pf": "breath", "n": "breath", "tx": "cough", "bg": "cough", "bb": "noise", "b": "noise", "sif": "noise", "conv": "noise", "mic": "noise", "pap": "noise", "shh": "noise",
    "pi": "inaudible", "pif": "inaudible", "pron=pi": "inaudible", "nontrans": "inaudible",
}
SOUND_WORDS = (
    ("pause", None), ("rire|rires|riant", "laughter"), ("applau", "applause"), ("musique", "music"), ("chant", "singing"), ("soupir", "sigh"), ("tou(x|sse)|r[aâ]clement", "cough"),
    ("respiration|inspiration|expiration|aspiration|souffl|reniflement|hhh|^pff?$", "breath"), ("incompr[ée]hensible|inaudible|inintelligible", "inaudible"), ("^bip", "beep"),
)
#: Descriptions of a pronunciation that stand for words nobody could make out. Fixed values.
UNHEARD = ("pi", "pif", "*", "pron=pi")


def sound_tag(description: Column) -> Column:
    """The [tag] of a sound, by its code or by what its description holds; null for pauses, [noise] for others."""
    said = F.lower(F.trim(description))
    tag = F.lit("[noise]")
    for pattern, name in reversed(SOUND_WORDS):
        tag = F.when(said.rlike(pattern), F.lit(f"[{name}]" if name else None)).otherwise(tag)
    by_tag: dict[str, list[str]] = {}
    for code, name in SOUND_CODES.items():
        by_tag.setdefault(name, []).append(code)
    for name, codes in by_tag.items():
        tag = F.when(said.isin(codes), F.lit(f"[{name}]")).otherwise(tag)
    return tag


def event_token(kind: Column, description: Column, extent: Column) -> Column:
    """What an event becomes: sounds their tag, once for a stretch; words nobody made out [inaudible]; all else nothing."""
    unheard = (kind == "pronounce") & (extent == "instantaneous") & F.trim(description).isin(*UNHEARD)
    return F.when(extent == "end", F.lit(None)).when(kind == "noise", sound_tag(description)).when(unheard, F.lit("[inaudible]"))


def rendered(items: Column, clean: Callable[[Column], Column] | None = None, event: Callable[[Column, Column, Column], Column] = event_token, comment: Callable[[Column], Column] | None = None) -> Column:
    """The text of ordered items (kind, text, type, extent): texts cleaned, events and comments as their tokens.

    Speakers give nothing, as does a token that is null or empty. Equal tags side by side become one, and ? and ! stand
    behind a space.
    """

    def token(x: Column) -> Column:
        said = clean(x["text"]) if clean else x["text"]
        remark = comment(x["text"]) if comment else F.lit(None).cast("string")
        return F.when(x["kind"] == "text", said).when(x["kind"] == "event", event(x["type"], x["text"], x["extent"])).when(x["kind"] == "comment", remark)

    tokens = F.filter(F.transform(items, token), lambda t: F.coalesce(t, F.lit("")) != "")
    text = F.trim(F.regexp_replace(F.array_join(tokens, " "), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(text, r"(\[[a-z]+\])( \1)+", "$1"), r"\s+([?!])", " $1")


def window_items(windows: DataFrame, items: DataFrame, width: float = 60.0, eps: float = 0.01) -> DataFrame:
    """windows(recording, seg_id, start, end) with `items`, those of the chunks that lie in each window, in order.

    items(recording, chunk, pos, start, end, kind, text, type, extent): a chunk is what stands between two time marks,
    its items are numbered by pos. A chunk lies in a window if both its ends do, within eps, and it isn't empty. Windows
    without a chunk get no row. Both sides meet in time bins of `width` seconds, so no recording is compared whole.
    """
    w = windows.select("recording", "seg_id", (F.col("start") - eps).alias("w_start"), (F.col("end") + eps).alias("w_end"))
    keyed = items.where(F.col("end") > F.col("start")).withColumn("bin", F.floor(F.col("start") / width))
    both = binned(w, "w_start", "w_end", width).join(keyed, ["recording", "bin"]).where((F.col("start") >= F.col("w_start")) & (F.col("end") <= F.col("w_end")))
    item = F.struct("start", "chunk", "pos", "kind", "text", "type", "extent")
    own = both.groupBy("recording", "seg_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return windows.join(own, ["recording", "seg_id"])


def alternatives(text: Column) -> Column:
    """The first of several hearings between slashes, /ça, chat/; 0 stands for nothing. Other slashes are spaces."""
    first = F.regexp_replace(text, r"/\s*0\s*,[^/]*/", "")
    return F.regexp_replace(F.regexp_replace(first, r"/([^/,]*),[^/]*/", "$1"), "/", " ")
