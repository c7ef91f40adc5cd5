"""Writers: manifests, pairs, outputs, shards, cuts, tables, cards; all are committed by Spark as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jsonl(rows: DataFrame, path: str, mode: str = "overwrite", gzip: bool = False) -> None:
    """JSON lines; nothing is visible before the job is committed. mode ignore skips what is there."""
    rows.write.mode(mode).option("compression", "gzip" if gzip else "none").json(path)


def raw_and_lean(rows: DataFrame, path: str, lean: list[str], split: str = "split") -> None:
    """Two manifests: all columns, and the lean ones, each with a folder for each split."""
    rows.write.mode("overwrite").partitionBy(split).json(f"{path}/raw")
    rows.select(*lean, split).write.mode("overwrite").partitionBy(split).json(f"{path}/lean")


def outputs(rows: DataFrame, path: str, column: str = "output") -> None:
    """A folder for each output of the cleaning pipeline; outputs written again replace their own folder only."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).json(path)


def resumed(rows: DataFrame, path: str, schema: str, item: str = "id") -> DataFrame:
    """The rows whose item isn't in a sink yet; a sink that isn't there holds nothing."""
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return rows
    return rows.join(spark.read.schema(schema).json(path).select(item), item, "left_anti")


def shards(rows: DataFrame, path: str, most: int, mode: str = "append") -> None:
    """Parquet shards of at most so many rows, zstd."""
    rows.write.mode(mode).option("maxRecordsPerFile", most).option("compression", "zstd").parquet(path)


def shard_state(spark: SparkSession, path: str) -> DataFrame:
    """(rows, shards, last): how many rows and files a shard folder has, and the last file's number."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("f")).groupBy("f").count()
    return files.agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("shards"), F.max(F.regexp_extract("f", r"part-(\d+)", 1).cast("int")).alias("last"))


def cut(item: Column, path: Column, offset: Column, duration: Column, rate: Column, text: Column, speaker: Column, language: Column) -> Column:
    """A cut with one recording and one supervision over all of it."""
    source = F.struct(F.lit("file").alias("type"), F.array(F.lit(0)).alias("channels"), path.alias("source"))
    end = offset + duration
    recording = F.struct(item.alias("id"), F.array(source).alias("sources"), rate.alias("sampling_rate"), F.bround(end * rate, 0).cast("long").alias("num_samples"), end.alias("duration"))
    said = F.struct(item.alias("id"), item.alias("recording_id"), F.lit(0.0).alias("start"), duration.alias("duration"), F.lit(0).alias("channel"), text.alias("text"), speaker.alias("speaker"), language.alias("language"))
    return F.struct(item.alias("id"), offset.alias("start"), duration.alias("duration"), F.lit(0).alias("channel"), F.array(said).alias("supervisions"), recording.alias("recording"), F.lit("MonoCut").alias("type"))


def cuts(rows: DataFrame, path: str, column: str = "cut") -> None:
    """Cuts as gzip JSON lines."""
    rows.select(f"{column}.*").write.mode("overwrite").option("compression", "gzip").json(path)


def statistics_csv(rows: DataFrame, path: str, order: list[str]) -> None:
    """A grouped table, sorted, in one CSV file with a header: it has a row for each group only."""
    rows.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_row(row: DataFrame, path: str) -> None:
    """A further part of a CSV table."""
    row.coalesce(1).write.mode("append").option("header", True).csv(path)


def split_index(rows: DataFrame, path: str, split: str, duration: str) -> None:
    """The index of an export: path/index, a JSON record (split, path) for each split, and path/statistics, a CSV table
    (split, n, hours)."""
    figures = rows.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("n"), (F.sum(duration) / 3600).alias("hours"))
    jsonl(figures.select("split", F.concat(F.lit("data/"), "split", F.lit(".jsonl")).alias("path")), f"{path}/index")
    statistics_csv(figures, f"{path}/statistics", ["split"])


def append_metrics(metrics: DataFrame, path: str, column: str = "metrics") -> None:
    """Further records of nested metrics, each a JSON line of a struct column."""
    metrics.select(f"{column}.*").write.mode("append").json(path)


def srt_text(cues: Column) -> Column:
    """Cues (start, end, text) as SRT, numbered from 1."""
    from ..functions.text import clock

    return F.array_join(F.transform(cues, lambda c, i: F.concat((i + 1).cast("string"), F.lit("\n"), clock(c["start"], ","), F.lit(" --> "), clock(c["end"], ","), F.lit("\n"), c["text"], F.lit("\n"))), "\n")


def weighted_yaml(nodes: list[dict], shares: dict[int, float]) -> str:
    """A mixture tree as YAML with weights, and each leaf's share as a comment. nodes: as flattened_tree gives them."""
    children: dict[int, list[dict]] = {}
    for n in nodes:
        children.setdefault(n["parent_id"], []).append(n)
    lines = ["input_cfg:"]

    def total(n: dict) -> float:
        return shares.get(n["node_id"], 0.0) if n["kind"] == "leaf" else sum(total(c) for c in children.get(n["node_id"], []))

    def walk(parent: int, pad: str) -> None:
        whole = sum(total(n) for n in children.get(parent, [])) or 1.0
        for n in children.get(parent, []):
            kind = "group" if n["kind"] == "group" else "multimodal_conversation"
            lines.extend([f"{pad}- type: {kind}", f"{pad}  weight: {total(n) / whole:.6f}"])
            if n["kind"] == "leaf":
                lines.append(f"{pad}  manifest_filepath: {n['manifest']}  # {100 * shares.get(n['node_id'], 0.0):.3f} %")
            else:
                lines.append(f"{pad}  input_cfg:")
                walk(n["node_id"], pad + "    ")

    walk(-1, "  ")
    return "\n".join(lines) + "\n"


def markdown_table(rows: DataFrame) -> str:
    """A grouped table of up to 10,000 rows as markdown; a larger one is an error, as it would be no card."""
    found = rows.limit(10_001).collect()
    if len(found) > 10_000:
        raise ValueError("the table is too large for a card")
    cells = [[str(v) if v is not None else "?" for v in r] for r in found]
    return "\n".join("| " + " | ".join(r) + " |" for r in [rows.columns, ["---"] * len(rows.columns), *cells]) + "\n"
