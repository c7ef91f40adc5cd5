"""Readers: manifests, tables, key-text lines, Kaldi, STM, CTM, SRT, word JSON, messages, listings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TURN = "struct<from:string,type:string,value:string,duration:double,offset:double>"
MANIFEST = f"id string, dataset_name string, language string, split string, speaker string, conversations array<{TURN}>, custom_metadata map<string,string>"


def manifest(spark: SparkSession, paths: str | list[str], schema: str = MANIFEST, tolerant: bool = True) -> DataFrame:
    """JSON-lines manifests, gzip by extension, globs and lists of paths, with `file`; bad lines are skipped or stop the read."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
    return reader.json(paths).withColumn("file", F.col("_metadata.file_path"))


def malformed(spark: SparkSession, paths: str | list[str], schema: str = MANIFEST) -> DataFrame:
    """(file, bad, good): how many lines of each file can't be read, blank ones apart."""
    fields = StructType.fromDDL(schema).add("_corrupt_record", "string")
    lines = spark.read.schema("value string").text(paths).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    bad = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull()
    return lines.withColumn("__bad", bad).groupBy("file").agg(F.count(F.when(F.col("__bad"), 1)).alias("bad"), F.count(F.when(~F.col("__bad"), 1)).alias("good"))


def expanded(path: str) -> list[str]:
    """Paths of a sharded name: _OP_0..51_CL_ stands for the numbers 0 to 51."""
    m = re.search(r"_OP_(\d+)\.\.(\d+)_CL_", path)
    if not m:
        return [path]
    return [p for k in range(int(m[1]), int(m[2]) + 1) for p in expanded(path[: m.start()] + str(k) + path[m.end() :])]


def index_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, rows) of .idx files of 8-byte offsets: one more offset than rows. Contents aren't read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), (F.floor(F.col("length") / 8) - 1).alias("rows"))


def delimited(spark: SparkSession, path: str | list[str], schema: str, header: bool = True, lists: list[str] = (), defaults: dict[str, object] | None = None, quoted: bool = True, sep: str | None = None) -> DataFrame:
    """CSV or TSV by extension, with defaults for empty columns; `lists` hold JSON arrays of texts."""
    first = path if isinstance(path, str) else path[0]
    sep = sep or ("\t" if first.split("?")[0].endswith((".tsv", ".txt")) else ",")
    out = spark.read.schema(schema).option("header", header).option("sep", sep).option("quote", "\"" if quoted else "").option("mode", "DROPMALFORMED").csv(path)
    for c in lists:
        out = out.withColumn(c, F.from_json(F.replace(F.col(c), F.lit("'"), F.lit("\"")), "array<string>"))
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def clip_index(spark: SparkSession, path: str, schema: str, clip: str, keep: DataFrame | None = None) -> DataFrame:
    """An unquoted TSV keyed by the clip's stem, for the stems in `keep` alone."""
    out = delimited(spark, path, schema, quoted=False, sep="\t").withColumn("stem", F.regexp_replace(F.substring_index(clip, "/", -1), r"\.[^.]*$", ""))
    return out if keep is None else out.join(keep.select("stem").distinct(), "stem", "left_semi")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema("value string").text(path).where(F.trim("value") != "")


def fields(spark: SparkSession, path: str | list[str], names: list[str], sep: str = "\t") -> DataFrame:
    """Headerless lines of exactly so many fields; others are skipped."""
    f = F.split("value", sep)
    return _lines(spark, path).where(F.size(f) == len(names)).select(*(F.get(f, F.lit(k)).alias(n) for k, n in enumerate(names)))


def key_text(spark: SparkSession, path: str | list[str], sep: str = r"\s") -> DataFrame:
    """(key, text): each line cut at its first separator; a line without one has an empty text."""
    f = F.split("value", sep, 2)
    return _lines(spark, path).select(F.get(f, F.lit(0)).alias("key"), F.coalesce(F.get(f, F.lit(1)), F.lit("")).alias("text"))


def kaldi(spark: SparkSession, folder: str, with_segments: bool) -> DataFrame:
    """(utt, audio, offset, end, text): a Kaldi folder's wav.scp, text and segments, joined by their ids."""
    audio = key_text(spark, f"{folder}/wav.scp").select(F.col("key").alias("recording"), F.col("text").alias("audio"))
    text = key_text(spark, f"{folder}/text").select(F.col("key").alias("utt"), "text")
    if not with_segments:
        return text.join(audio.withColumnRenamed("recording", "utt"), "utt").select("utt", "audio", F.lit(0.0).alias("offset"), F.lit(None).cast("double").alias("end"), "text")
    cuts = fields(spark, f"{folder}/segments", ["utt", "recording", "offset", "end"], r"\s+")
    cuts = cuts.withColumn("offset", F.col("offset").try_cast("double")).withColumn("end", F.col("end").try_cast("double"))
    return cuts.join(text, "utt").join(audio, "recording").select("utt", "audio", "offset", "end", "text")


def stm(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(recording, channel, speaker, start, end, label, gender, text): STM lines; a note in parentheses at the end goes."""
    f = F.split("value", r"\s+", 7)
    g = lambda k: F.get(f, F.lit(k))
    rows = _lines(spark, path).where(~F.col("value").startswith(";;")).where(F.size(f) == 7)
    gender = F.regexp_extract(F.lower(g(5)), r"\b(female|male)\b", 1)
    return rows.select(
        g(0).alias("recording"), g(1).alias("channel"), g(2).alias("speaker"), g(3).try_cast("double").alias("start"), g(4).try_cast("double").alias("end"), g(5).alias("label"),
        F.when(gender != "", gender).alias("gender"), F.trim(F.regexp_replace(g(6), r"\s*\([^()]*\)\s*$", "")).alias("text"),
    )


def ctm(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(utt, words): CTM lines as words with start and end, in the order of time."""
    rows = fields(spark, path, ["utt", "channel", "start", "dur", "word"], r"\s+")
    start = F.col("start").try_cast("double")
    word = F.struct(start.alias("start"), (start + F.col("dur").try_cast("double")).alias("end"), "word")
    ordered = F.array_sort(F.collect_list(word))
    return rows.groupBy("utt").agg(F.transform(ordered, lambda w: F.struct(w["word"].alias("word"), w["start"].alias("start"), w["end"].alias("end"))).alias("words"))


def _clock(c: Column) -> Column:
    p = F.split(F.replace(c, F.lit(","), F.lit(".")), ":")
    return F.get(p, F.lit(0)).cast("double") * 3600 + F.get(p, F.lit(1)).cast("double") * 60 + F.get(p, F.lit(2)).cast("double")


def srt(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, number, start, end, speaker, text): the cues of SRT files; "Name: " in front of a text is its speaker."""
    cue = r"(?m)^(\d+)[ \t]*\r?\n(\d+:\d+:\d+[,.]\d+) --> (\d+:\d+:\d+[,.]\d+)[^\n]*\n((?:(?!\r?$)[^\n]*\n?)*)"
    whole = spark.read.schema("value string").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    c = whole.select("file", F.explode(F.regexp_extract_all("value", F.lit(cue), 0)).alias("c"))
    part = lambda k: F.regexp_extract("c", cue, k)
    text = F.trim(F.regexp_replace(part(4), r"\s+", " "))
    speaker = F.regexp_extract(text, r"^([\p{Lu}][\p{L}0-9_ ]{0,30}): ", 1)
    return c.select("file", part(1).cast("int").alias("number"), _clock(part(2)).alias("start"), _clock(part(3)).alias("end"), F.when(speaker != "", speaker).alias("speaker"), F.regexp_replace(text, r"^[\p{Lu}][\p{L}0-9_ ]{0,30}: ", "").alias("text"))


def whisper_words(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, pos, word, start, end): the words of all segments of word JSON files."""
    schema = "segments array<struct<words:array<struct<word:string,start:double,end:double>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))
    return rows.select("file", F.posexplode(F.flatten(F.transform("segments", lambda s: F.coalesce(s["words"], F.array().cast("array<struct<word:string,start:double,end:double>>"))))).alias("pos", "w")).select("file", "pos", "w.word", "w.start", "w.end")


def messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, text parts, audio): Parquet messages; of the audio only what is asked for is read."""
    m = spark.read.parquet(path)
    return m.select(*(c for c in m.columns if c != "messages"), F.transform("messages", lambda x: F.struct(x["role"].alias("role"), F.array_join(F.transform(F.filter(x["content"], lambda c: c["type"] == "text"), lambda c: c["text"]), " ").alias("text"), F.size(F.filter(x["content"], lambda c: c["type"] == "audio")).alias("audios"))).alias("messages"))


def audio_index(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("wav", "flac", "mp3"), exclude: list[str] = ()) -> DataFrame:
    """(path, name, stem, parent): the audio files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    name = F.substring_index("path", "/", -1)
    out = files.where(F.lower(F.substring_index("path", ".", -1)).isin(*extensions))
    for e in exclude:
        out = out.where(~F.col("path").contains(e))
    return out.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.try_element_at(F.split("path", "/"), F.lit(-2)).alias("parent"))


def results(spark: SparkSession, folder: str, name: str = "results.json") -> DataFrame:
    """(step, dataset, metric, value) of the files step=*/name below a folder, in long form."""
    raw = spark.read.schema("value string").text(f"{folder}/step=*/{name}", wholetext=True).select("value", F.regexp_extract("_metadata.file_path", r"step=(\d+)", 1).cast("long").alias("step"))
    sets = raw.select("step", F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("dataset", "m"))
    long = sets.select("step", "dataset", F.explode("m").alias("metric", "v"))
    return long.select("step", "dataset", "metric", F.col("v").try_cast("double").alias("value")).where("value is not null")
