"""Queries of §2.1 and §2.2: what is written in a format is read back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers as R
from ..sources import writers as W
from ..sources.scratch import scratch
from .tables import MANIFEST, manifest, query, table
from .turn_queries import _flat, flat_sql


@query(f"with {MANIFEST} select conv_id::varchar as id, {flat_sql('conversations')} as turns from manifest")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "manifest")
    W.jsonl(manifest(spark, d).select(F.col("conv_id").cast("string").alias("id"), "conversations"), path, gzip=True)
    return R.manifest(spark, path).select("id", _flat(F.col("conversations")).alias("turns"))


@query("select count(*) as good, 0::bigint as bad from conversations")
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "lines")
    W.jsonl(table(spark, d, "conversations"), path)
    counts = R.malformed(spark, path, "conv_id long, turn long, role string, text string")
    return counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


@query("select p_partkey, p_name, coalesce(nullif(p_brand, ''), 'none') as p_brand, p_size from part")
def tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "part") + ".tsv"
    table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size").write.option("header", True).option("sep", "\t").csv(path)
    return R.delimited(spark, path, "p_partkey long, p_name string, p_brand string, p_size int", defaults={"p_brand": "none"})


@query("select 'u' || c_custkey as key, c_name || ' ' || c_mktsegment as text from customer")
def key_text_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "text")
    table(spark, d, "customer").select(F.concat_ws(" ", F.concat(F.lit("u"), "c_custkey"), "c_name", "c_mktsegment")).write.text(path)
    return R.key_text(spark, path)


@query("""select 'u' || event_id as utt, 'a/' || user_id || '.wav' as audio, round((event_id % 1000)::double, 3) as "offset", round(event_id % 1000 + 1.5, 3)::double as "end", event_type || ' ' || event_id as text from events""")
def kaldi_folder(spark: SparkSession, d: str) -> DataFrame:
    e, path = table(spark, d, "events"), scratch(spark, "kaldi")
    utt, rec = F.concat(F.lit("u"), "event_id"), F.concat(F.lit("r"), "user_id")
    e.select(F.concat_ws(" ", rec, F.concat(F.lit("a/"), "user_id", F.lit(".wav")))).distinct().write.text(f"{path}/wav.scp")
    e.select(F.concat_ws(" ", utt, "event_type", "event_id")).write.text(f"{path}/text")
    start = F.col("event_id") % 1000
    e.select(F.concat_ws(" ", utt, rec, start.cast("double").cast("string"), (start + 1.5).cast("string"))).write.text(f"{path}/segments")
    return R.kaldi(spark, path, True)


@query("""select 'r' || user_id as recording, event_type as speaker, (event_id % 1000)::double as "start", (event_id % 1000)::double + 2 as "end", case when event_id % 2 = 0 then 'female' else 'male' end as gender, 'w' || event_id as text from events""")
def stm_lines(spark: SparkSession, d: str) -> DataFrame:
    path, i = scratch(spark, "stm"), F.col("event_id")
    line = F.concat_ws(" ", F.concat(F.lit("r"), "user_id"), F.lit("1"), "event_type", (i % 1000).cast("string"), (i % 1000 + 2).cast("string"), F.when(i % 2 == 0, "<o,f0,female>").otherwise("<o,f0,male>"), F.concat(F.lit("w"), i, F.lit(" (note)")))
    table(spark, d, "events").select(line).write.text(path)
    return R.stm(spark, path).select("recording", "speaker", "start", "end", "gender", "text")


@query("""select user_id::varchar as utt, count(*)::int as n, string_agg('w' || event_id, ' ' order by event_id) as words from events group by user_id""")
def ctm_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "ctm")
    table(spark, d, "events").select(F.concat_ws(" ", "user_id", F.lit("1"), F.col("event_id").cast("double").cast("string"), F.lit("0.5"), F.concat(F.lit("w"), "event_id"))).write.text(path)
    return R.ctm(spark, path).select("utt", F.size("words").alias("n"), F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("words"))


@query("""select item_id, 1 + (item_id % 3)::int as number, (0.5 + item_id % 3)::double as "start", text from (select item_id, regexp_replace(trim(text), '\\s+', ' ', 'g') as text from benchmark)""")
def srt_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "srt")
    i = F.col("item_id") % 3
    text = F.regexp_replace(F.trim("text"), r"\s+", " ")
    cues = table(spark, d, "benchmark").select("item_id", F.array(*(F.struct(F.lit(k + 0.5).alias("start"), F.lit(k + 1.0).alias("end"), F.when(i == k, F.concat(F.lit("S: "), text)).otherwise("x").alias("text")) for k in range(3))).alias("cues"))
    cues.select(F.concat(F.col("item_id").cast("string"), F.lit("\n"), W.srt_text(F.col("cues"))).alias("value"), "item_id").write.partitionBy("item_id").text(path)
    back = R.srt(spark, f"{path}/item_id=*")
    return back.where("speaker = 'S'").select(F.regexp_extract("file", r"item_id=(\d+)", 1).cast("long").alias("item_id"), "number", F.round("start", 3).alias("start"), "text")


@query("""select vec_id, label, 'user' as role, 'v' || vec_id as text, 1 as audios from embeddings""")
def parquet_messages(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "messages")
    part = lambda kind, text, audio: F.struct(F.lit(kind).alias("type"), text.alias("text"), audio.alias("audio"))
    audio = F.struct(F.col("embedding").alias("array"), F.lit(16000).alias("sampling_rate"), F.lit("x").alias("path"))
    content = F.array(part("text", F.concat(F.lit("v"), "vec_id"), F.lit(None).cast("struct<array:array<float>,sampling_rate:int,path:string>")), part("audio", F.lit(None).cast("string"), audio))
    W.shards(table(spark, d, "embeddings").select("vec_id", "label", F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("messages")), path, 200)
    m = R.messages(spark, path).select("vec_id", "label", F.get("messages", F.lit(0)).alias("m"))
    return m.select("vec_id", "label", "m.role", "m.text", "m.audios")


@query("""select count(*)::bigint as rows, 400::int as most from embeddings""")
def shard_counts(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "shards")
    W.shards(table(spark, d, "embeddings").select("vec_id"), path, 400)
    return W.shard_state(spark, path).select("rows", F.lit(400).alias("most"))


@query("""select doc_id from documents where doc_id % 3 <> 0""")
def resume_by_anti_join(spark: SparkSession, d: str) -> DataFrame:
    path, docs = scratch(spark, "done"), table(spark, d, "documents").select("doc_id")
    W.jsonl(docs.where("doc_id % 3 = 0"), path)
    return W.resumed(docs, path, "doc_id long", "doc_id")


@query("""select lang, split, count(*) as n from (select lang, case when doc_id % 10 = 0 then 'test' else 'train' end as split from documents) group by all""")
def raw_and_lean_pair(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "pair")
    docs = table(spark, d, "documents").withColumn("split", F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train"))
    W.raw_and_lean(docs, path, ["doc_id", "lang"])
    return spark.read.schema("doc_id long, lang string, split string").json(f"{path}/lean").groupBy("lang", "split").agg(F.count(F.lit(1)).alias("n"))


@query("""select event_id::varchar as id, (event_id % 7)::double as "start", value as duration, 16000 as rate, event_type as text from events""")
def cut_records(spark: SparkSession, d: str) -> DataFrame:
    e, path = table(spark, d, "events"), scratch(spark, "cuts")
    c = W.cut(F.col("event_id").cast("string"), F.concat(F.lit("a/"), "user_id"), (F.col("event_id") % 7).cast("double"), F.col("value"), F.lit(16000), F.col("event_type"), F.col("user_id").cast("string"), F.lit("en"))
    W.cuts(e.select(c.alias("cut")), path)
    back = spark.read.schema("id string, start double, duration double, supervisions array<struct<text:string>>, recording struct<sampling_rate:int>").json(path)
    return back.select("id", "start", "duration", F.col("recording.sampling_rate").alias("rate"), F.get("supervisions", F.lit(0))["text"].alias("text"))


@query("""select 'm_' || i || '.json' as path from range(0, 52) t(i)""")
def sharded_paths(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(p,) for p in R.expanded("m__OP_0..51_CL_.json")], "path string")
