"""Queries of §2.1, §2.2 and §2.12 on mixture trees of any depth, lines by number, torn files and ordered parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trees as T
from ..sources import indexed as I
from ..sources import writers as W
from ..sources.scratch import scratch
from .tables import query, table

#: A tree of regions, nations and suppliers; every seventh supplier stands in a group of its own. Some have weights.
TREE = """tree as (select 'r' || r_regionkey as node, null::varchar as parent, r_regionkey::bigint as ordinal, 'group' as kind, case when r_regionkey = 1 then 0.4 when r_regionkey = 2 then 0.1 end::double as weight, null::double as size from region
 union all select 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, 'group', case when n_nationkey % 4 = 1 then 0.3 end, null from nation
 union all select 'g' || s_suppkey, 'n' || s_nationkey, s_suppkey, 'group', null, null from supplier where s_suppkey % 7 = 0
 union all select 's' || s_suppkey, case when s_suppkey % 7 = 0 then 'g' || s_suppkey else 'n' || s_nationkey end, s_suppkey, 'leaf', case when s_suppkey % 5 = 2 then 0.05 end, 10 + s_suppkey % 40 from supplier)"""


def _tree(spark: SparkSession, d: str) -> DataFrame:
    """(node, parent, ordinal, kind, weight, size), as in TREE; groups without a leaf are in it."""
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("double")
    name = lambda letter, c: F.concat(F.lit(letter), c)
    r, n, s = (table(spark, d, t) for t in ("region", "nation", "supplier"))
    k = F.col("s_suppkey")
    regions = r.select(name("r", "r_regionkey").alias("node"), none.alias("parent"), F.col("r_regionkey").cast("long").alias("ordinal"), F.lit("group").alias("kind"), F.when(F.col("r_regionkey") == 1, 0.4).when(F.col("r_regionkey") == 2, 0.1).alias("weight"), nothing.alias("size"))
    nations = n.select(name("n", "n_nationkey"), name("r", "n_regionkey"), F.col("n_nationkey").cast("long"), F.lit("group"), F.when(F.col("n_nationkey") % 4 == 1, 0.3), nothing)
    single = s.where(k % 7 == 0).select(name("g", "s_suppkey"), name("n", "s_nationkey"), k.cast("long"), F.lit("group"), nothing, nothing)
    leaves = s.select(name("s", "s_suppkey"), F.when(k % 7 == 0, name("g", "s_suppkey")).otherwise(name("n", "s_nationkey")), k.cast("long"), F.lit("leaf"), F.when(k % 5 == 2, 0.05), (10 + k % 40).cast("double"))
    return regions.union(nations).union(single).union(leaves)


@query(f"""with recursive {TREE}, sc as (select *, case when weight is not null then 0 when kind = 'group' then 1 when size > 0 then pow(size, 0.5) else 0 end::double as score from tree),
p as (select *, sum(coalesce(weight, 0)) over w as explicit, sum(score) over w as free from sc window w as (partition by parent)),
q as (select *, case when weight is null then case when free > 0 then greatest(0, 1 - explicit) * score / free else 0 end when free > 0 or explicit = 0 then weight else weight / explicit end as part from p),
walk as (select node, kind, part as share from q where parent is null union all select q.node, q.kind, q.part * walk.share from q join walk on q.parent = walk.node)
select node, round(share, 10) as share from walk where kind = 'leaf'""")
def tree_shares(spark: SparkSession, d: str) -> DataFrame:
    return T.leaf_shares(_tree(spark, d)).select("node", F.round("share", 10).alias("share"))


@query(f"""with {TREE} select node, (case when ordinal % 5 = 0 then 2 else 0 end)::int as epoch, (ordinal % 4)::int as shard_id, (ordinal * 3 % 11)::bigint as position,
 (case when ordinal % 5 = 0 then 2 else 0 end * ceil((size - ordinal % 4) / 4) + ordinal * 3 % 11)::bigint as seen from tree where kind = 'leaf'""")
def loader_states(spark: SparkSession, d: str) -> DataFrame:
    """States of a loader over the tree: a mux for each group of several that holds a leaf, filters around every third leaf."""
    tree = _tree(spark, d)
    full = tree.where("kind = 'leaf'").select("node", "parent")
    groups = tree.where("kind = 'group'").select("node", "parent")
    # Groups without a leaf below are no part of a mixture.
    held = full.select(F.col("parent").alias("node")).union(groups.where("node like 'g%'").select(F.col("parent").alias("node"))).distinct()
    held = held.union(held.join(groups, "node").where("parent is not null").select("parent")).distinct()
    tree = tree.join(held.withColumn("held", F.lit(True)), "node", "left").where("kind = 'leaf' or held or node like 'g%'").drop("held")
    sizes = tree.groupBy("parent").agg(F.count("*").alias("n"))
    groups = tree.where("kind = 'group'").join(sizes.select(F.col("parent").alias("node"), "n"), "node")
    mux = groups.select("node", "parent", "ordinal", F.when(F.col("n") > 1, "mux").otherwise("wrapper").alias("kind"))
    top = tree.where("parent is null").agg(F.when(F.count("*") > 1, "mux").otherwise("wrapper").alias("kind")).select(F.lit("root").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("ordinal"), "kind")
    leaves = tree.where("kind = 'leaf'")
    wrapped = leaves.where("ordinal % 3 = 0").select(F.concat(F.lit("f"), "node").alias("node"), "parent", "ordinal", F.lit("wrapper").alias("kind"))
    ends = leaves.select("node", F.when(F.col("ordinal") % 3 == 0, F.concat(F.lit("f"), "node")).otherwise(F.col("parent")).alias("parent"), "ordinal", F.lit("leaf").alias("kind"))
    o = F.col("ordinal")
    state = top.union(mux.withColumn("parent", F.coalesce("parent", F.lit("root")))).union(wrapped).union(ends)
    leaf = F.col("kind") == "leaf"
    state = state.select("node", "parent", "ordinal", "kind", F.when(leaf, o * 3 % 11).alias("position"), F.when(leaf, F.when(o % 5 == 0, 2).otherwise(0)).alias("epoch"), F.when(leaf, (o % 4).cast("int")).alias("shard_id"), F.when(leaf, 4).alias("num_shards"))
    return T.states_of_leaves(tree, state).select("node", "epoch", "shard_id", "position", F.col("seen").cast("long").alias("seen"))


def _line_files(spark: SparkSession, d: str) -> dict[str, str]:
    """The files of events, one for each type, in the order of their ids."""
    path = scratch(spark, "lines")
    e = table(spark, d, "events").select("event_type", "event_id", "value")
    e.repartition("event_type").sortWithinPartitions("event_type", "event_id").write.partitionBy("event_type").json(path)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/event_type=*").select("path")
    return {r["path"].partition("event_type=")[2].partition("/")[0]: r["path"] for r in found.collect()}


@query("""with e as (select *, row_number() over (partition by event_type order by event_id) - 1 as row from events) select event_type, row, event_id, value from e where row in (0, 5, 170, 171) and event_type < 'm' or row >= 20 and row < 300 and event_type > 'm'""")
def indexed_line_scan(spark: SparkSession, d: str) -> DataFrame:
    """Chosen lines of five files, by their numbers: named ones of some files, a range of others."""
    files = _line_files(spark, d)
    I.write_indexes(spark, list(files.values())).collect()
    out = None
    for kind, path in files.items():
        rows = I.indexed_lines(spark, path, 64)
        rows = rows.where("row in (0, 5, 170, 171)") if kind < "m" else rows.where("row >= 20 and row < 300")
        told = rows.select(F.lit(kind).alias("event_type"), "row", F.from_json("line", "event_id long, value double").alias("x")).select("event_type", "row", "x.event_id", "x.value")
        out = told if out is None else out.unionByName(told)
    return out


@query("""select event_type, count(*) as rows from events group by event_type""")
def line_index_rows(spark: SparkSession, d: str) -> DataFrame:
    files = _line_files(spark, d)
    rows = I.write_indexes(spark, list(files.values()))
    return rows.select(F.regexp_extract("path", r"event_type=(\w+)", 1).alias("event_type"), "rows")


@query("""select doc_id, row_number() over (order by doc_id % 3 <> 0, doc_id) - 1 as line from documents""")
def resumed_parts(spark: SparkSession, d: str) -> DataFrame:
    """A sink that a writer left torn, resumed, and its parts put together in order: as many lines as one whole run has."""
    path, docs = scratch(spark, "torn"), table(spark, d, "documents").select("doc_id")
    W.jsonl(docs.where("doc_id % 3 = 0").orderBy("doc_id"), f"{path}/one")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    torn = jvm.Path(f"{path}/one/part-99999-torn.json")
    out = torn.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(torn)
    out.write(bytearray(b'{"doc_id":1'))
    out.close()
    files = lambda folder: sorted(r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path").collect())
    I.trimmed_tails(spark, files(f"{path}/one")).collect()
    W.jsonl(W.resumed(docs, f"{path}/one", "doc_id long", "doc_id").orderBy("doc_id"), f"{path}/two")
    I.concatenated(spark, files(f"{path}/one") + files(f"{path}/two"), f"{path}/all")
    whole = files(f"{path}/all")
    counts = {r["f"]: r["n"] for r in spark.read.text(whole).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for f in whole:
        name = f.rpartition("/")[2]
        starts.append((name, at))
        at += sum(n for k, n in counts.items() if k.endswith("/" + name))
    order = spark.createDataFrame(starts, "name string, start long")
    lines = spark.read.text(whole).select("value", F.col("_metadata.file_name").alias("name"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("block"))
    from pyspark.sql import Window

    inside = F.row_number().over(Window.partitionBy("name").orderBy("block", "at")) - 1
    numbered = lines.withColumn("inside", inside).join(order, "name")
    return numbered.select(F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"), (F.col("start") + F.col("inside")).alias("line"))
