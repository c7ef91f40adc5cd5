"""Subtitle cues: the run of cues that a segment was joined from, and its text rebuilt from theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sound notes between asterisks, brackets around asides, a dash that opens a speaker's line, and letters struck out.
NOTE, BRACKET, DASH, STRUCK = r"\*([^*]{2,40})\*", r"[()\[\]{}]", r"(^|(?<=[.?!…] ))[-–—]+\s*(?=\p{L})", r"\w[%*#@]+\w"
#: Tags of sound notes by what they say. Fixed values.
SOUNDS = (("laughter", r"\bri(re|res|t|gol)"), ("cough", r"\btouss"), ("music", r"\b(musique|chanson)"), ("applause", r"\bapplaudi"))
#: What may stand before a capital letter without a full stop being added.
MARKS = r"[\p{P}\p{S}]$"


def cue_text(text: Column) -> Column:
    """A cue's words: asides without brackets, known sound notes as [tag], others gone, no dash before a speaker's line."""
    plain = F.regexp_replace(text, BRACKET, " ")
    pieces = F.split(plain, r"(?=\*[^*]{2,40}\*)|(?<=\*)(?<=\*[^*]{2,40}\*)")

    def told(piece: Column) -> Column:
        tag = F.lit(" ")
        for name, pattern in reversed(SOUNDS):
            tag = F.when(F.lower(piece).rlike(pattern), F.lit(f" [{name}] ")).otherwise(tag)
        return F.when(piece.rlike(rf"^{NOTE}$"), tag).otherwise(piece)

    return F.trim(F.regexp_replace(F.array_join(F.transform(pieces, told), ""), DASH, ""))


def joined(texts: Column) -> Column:
    """Cue texts as one text: a full stop before a cue in capitals whose predecessor has no mark, one space elsewhere."""

    def add(acc: Column, t: Column) -> Column:
        stop = ~acc.rlike(MARKS) & t.rlike(r"^\p{Lu}")
        return F.when(t == "", acc).when(acc == "", t).when(stop, F.concat(acc, F.lit(". "), t)).otherwise(F.concat(acc, F.lit(" "), t))

    return F.trim(F.regexp_replace(F.aggregate(texts, F.lit(""), add), r"\s+", " "))


def cue_runs(segments: DataFrame, cues: DataFrame, eps: float = 0.002, pause: float = 1.0, longest: float = 30.0) -> DataFrame:
    """segments(recording, seg_id, start, end) with n_cues and cues, the run of cues that each was joined from: 0 and null if there is none.

    cues(recording, cue_id, start, end, text). The run begins with the cue of the segment's id, if it starts within eps
    of the segment; further cues in the order of (start, end, id) join it until its end is within eps of the segment's.
    It breaks before a cue that begins more than `pause` after the run's end, or ends more than `longest` after the
    segment's start; a run that breaks, or comes to the last cue, elsewhere than at the segment's end is no match.

    A run lies within `longest` seconds, so segments and cues meet by bins of that width: each segment in two of them,
    each cue in one, however long the recording. The walk is a fold over the cues of one segment.
    """
    bin_ = lambda c: F.floor(F.col(c) / longest)
    # The first cue may begin eps before its segment, so bins reach from there.
    keyed = segments.select("recording", "seg_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end")).withColumn("bin", F.explode(F.sequence(F.floor((F.col("seg_start") - eps) / longest), F.floor((F.col("seg_start") + longest) / longest))))
    near = keyed.join(cues.withColumn("bin", bin_("start")), ["recording", "bin"])
    near = near.where((F.col("start") >= F.col("seg_start") - eps) & (F.col("start") <= F.col("seg_start") + longest))
    own = near.groupBy("recording", "seg_id", "seg_start", "seg_end").agg(F.array_sort(F.collect_list(F.struct("start", "end", "cue_id", "text"))).alias("near"))
    kind = "array<struct<start:double,end:double,cue_id:string,text:string>>"
    near_ = F.transform("near", lambda c: F.struct(c["start"].cast("double").alias("start"), c["end"].cast("double").alias("end"), c["cue_id"].cast("string").alias("cue_id"), c["text"].alias("text")))
    begin = F.struct(F.array().cast(kind).alias("run"), F.lit(0.0).alias("at"), F.lit(False).alias("over"))

    def walk(acc: Column, c: Column) -> Column:
        empty = F.size(acc["run"]) == 0
        first = empty & (c["cue_id"] == F.col("seg_id").cast("string")) & (c["start"] <= F.col("seg_start") + eps)
        reached = F.abs(acc["at"] - F.col("seg_end")) <= eps
        stop = acc["over"] | ~empty & (reached | (c["start"] - acc["at"] > pause) | (c["end"] - F.col("seg_start") > longest))
        grown = F.struct(F.concat(acc["run"], F.array(c)).cast(kind).alias("run"), c["end"].alias("at"), F.lit(False).alias("over"))
        return F.when(stop, F.struct(acc["run"].alias("run"), acc["at"].alias("at"), F.lit(True).alias("over"))).when(~empty | first, grown).otherwise(acc)

    told = own.withColumn("run", F.aggregate(near_, begin, walk))
    whole = (F.size("run.run") > 0) & (F.abs(F.col("run.at") - F.col("seg_end")) <= eps)
    runs = told.where(whole).select("recording", "seg_id", F.col("run.run").alias("cues"), F.size("run.run").alias("n_cues"))
    return segments.join(runs, ["recording", "seg_id"], "left").withColumn("n_cues", F.coalesce("n_cues", F.lit(0)))


def rebuilt_from_cues(segments: DataFrame, cues: DataFrame, **limits: float) -> DataFrame:
    """segments(recording, seg_id, start, end, text) with the text of their cues, and `outcome`.

    rebuilt: the cues' text; unmatched: there is no run, the text stays; empty: the cues say nothing, the text stays;
    sound_note_only: they hold nothing but sound notes without a tag, no text; censored: letters are struck out, no text.
    """
    runs = cue_runs(segments, cues, **limits)
    new = joined(F.transform("cues", lambda c: cue_text(F.coalesce(c["text"], F.lit("")))))
    some = F.exists("cues", lambda c: F.coalesce(c["text"], F.lit("")) != "")
    told = runs.withColumn("__new", F.when(F.col("cues").isNotNull(), new)).withColumn("__some", some)
    outcome = F.when(F.col("__new").isNull(), "unmatched").when(F.col("__new").rlike(STRUCK), "censored").when(F.col("__new") != "", "rebuilt").when(F.col("__some"), "sound_note_only").otherwise("empty")
    told = told.withColumn("outcome", outcome)
    text = F.when(F.col("outcome") == "rebuilt", F.col("__new")).when(F.col("outcome").isin("unmatched", "empty"), F.col("text"))
    return told.withColumn("text", text).drop("__new", "__some", "cues")
