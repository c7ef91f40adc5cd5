"""The driver's tables in the roles of the engine, for Spark and for SQL; and the registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function as a query under its name, with its SQL if there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver; one of long texts in as many partitions as there are cores, if its files have fewer."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages") else rows


def spread(rows: DataFrame) -> DataFrame:
    """A scan in at least as many partitions as the session has cores: few small files are dealt anew, many aren't."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, conversations): conversations as manifest records; a system turn stands for an audio turn of the user."""
    t = table(spark, sf_dir, "conversations")
    audio = F.col("role") == "system"
    none = F.lit(None).cast("double")
    turn = F.struct(
        "turn",
        F.when(F.col("role") == "assistant", "Assistant").otherwise("User").alias("from"),
        F.when(audio, "audio").otherwise("text").alias("type"),
        F.col("text").alias("value"),
        F.when(audio, F.length("text") / 10.0).otherwise(none).alias("duration"),
        F.when(audio, F.col("turn").cast("double")).otherwise(none).alias("offset"),
    )
    ordered = F.array_sort(F.collect_list(turn))
    return t.groupBy("conv_id").agg(F.transform(ordered, lambda x: x.dropFields("turn")).alias("conversations"))


#: The same in SQL.
MANIFEST = """manifest as (select conv_id, list(struct_pack("from" := case when role = 'assistant' then 'Assistant' else 'User' end,
 "type" := case when role = 'system' then 'audio' else 'text' end, "value" := text,
 duration := case when role = 'system' then length(text) / 10.0 end::double, "offset" := case when role = 'system' then turn end::double) order by turn) as conversations
 from conversations group by conv_id)"""


def segments(spark: SparkSession, sf_dir: str, stretch: float = 60.0) -> DataFrame:
    """(recording, seg_id, speaker, start, end, text): events as segments of recordings, in seconds."""
    e = table(spark, sf_dir, "events")
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / F.lit(1e6)
    return e.select(F.col("user_id").alias("recording"), F.col("event_id").alias("seg_id"), F.col("event_type").alias("speaker"), start.alias("start"), (start + F.col("value") * stretch).alias("end"), F.col("props").alias("text"))


def segments_sql(stretch: float = 60.0, name: str = "segments") -> str:
    """The same in SQL."""
    return f"""{name} as (select user_id as recording, event_id as seg_id, event_type as speaker, epoch_us(ts) / 1e6::double as "start",
 epoch_us(ts) / 1e6::double + value * {stretch} as "end", props as text from events)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task, lang, dataset, duration, words, speaker): line items as samples of a corpus; the small tables are dimensions."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_linenumber", "l_partkey")  # noqa: E741
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        l.join(o, l["l_orderkey"] == o["o_orderkey"])
        .join(s, l["l_suppkey"] == s["s_suppkey"])
        .join(n, s["s_nationkey"] == n["n_nationkey"])
        .select(
            F.col("o_orderpriority").alias("task"), F.col("n_name").alias("lang"), F.col("s_name").alias("dataset"), F.col("l_quantity").alias("duration"),
            F.col("l_linenumber").cast("long").alias("words"), F.col("o_custkey").alias("speaker"), F.col("l_partkey").alias("part"),
        )
    )


#: The same in SQL.
CORPUS = """corpus as (select o_orderpriority as task, n_name as lang, s_name as dataset, l_quantity as duration, l_linenumber::bigint as words, o_custkey as speaker, l_partkey as part
 from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"""
