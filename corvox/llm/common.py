"""What the operators of this package share: the shared folder, written steps, distributed running totals."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_folders: list = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder of its own; a cluster session is refused, as a
    folder of one machine can't be seen by the others.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="corvox-")
    sc.setCheckpointDir(found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when this process ends."""
    path = f"{shared_folder(spark)}/corvox-{uuid.uuid4().hex}-{name}"
    if not _folders:
        atexit.register(_clear, spark)
    _folders.append(path)
    return path


def _clear(spark: SparkSession) -> None:
    try:
        jvm = spark.sparkContext._jvm
        for path in _folders:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the session has ended; its owner clears the folder
        pass


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a `written` table that nothing will read again."""
    path = getattr(df, "_corvox_path", None)
    if path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _folders.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._corvox_path = path
    return back


def more_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of df with the fields of a DDL string behind."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def running_total(df: DataFrame, keys: list[str], buckets: tuple[Column, Column], order: list[str], size: str | None, out: str, totals_from: DataFrame | None = None) -> DataFrame:
    """Adds `out`: the sum of `size` (or the number of rows) before each row of its group, in the given order.

    No task ever holds a whole group. `buckets` are a coarse and a fine cut of the groups, the fine one inside the
    coarse one; neither falls along `order`. Rows are ranked inside their fine bucket, the totals of fine buckets inside
    their coarse one, and only the totals of coarse buckets along the group. keys must not be null. totals_from, where
    the buckets' columns, the keys and the size are already at hand, spares computing them twice. df has no columns
    with the names of the working columns, which start with two underscores.
    """
    amount = F.col(size) if size else F.lit(1)
    coarse, fine = buckets
    cut = df.withColumn("__coarse", coarse).withColumn("__fine", fine)
    source = cut if totals_from is None else totals_from.withColumn("__coarse", coarse).withColumn("__fine", fine)
    before = lambda own, by: Window.partitionBy(*own).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    totals = source.groupBy(*keys, "__coarse", "__fine").agg(F.sum(amount).alias("__total"))
    above = totals.groupBy(*keys, "__coarse").agg(F.sum("__total").alias("__total"))
    above = above.select(*keys, "__coarse", F.coalesce(F.sum("__total").over(before(keys, "__coarse")), F.lit(0)).alias("__above"))
    starts = totals.select(*keys, "__coarse", "__fine", F.coalesce(F.sum("__total").over(before([*keys, "__coarse"], "__fine")), F.lit(0)).alias("__start"))
    starts = starts.join(above, [*keys, "__coarse"]).select(*keys, "__coarse", "__fine", (F.col("__above") + F.col("__start")).alias("__start"))
    inside = Window.partitionBy(*keys, "__coarse", "__fine").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(starts, [*keys, "__coarse", "__fine"])
        .withColumn(out, (F.col("__start") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).cast("long"))
        .drop("__coarse", "__fine", "__start")
    )


def placed(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """df with `out`, the place of each row, from 0, in the given order of all rows; written to the shared folder.

    A range sort: rows are dealt by sampled bounds of the order and sorted in their ranges, so no task holds a group;
    the ranges' sizes, one row for each, are added up. Rows that are equal in the order stand in any order. df should
    be read from files, as it is read twice; it has no columns with the names of the working ones.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    at = written(ranged.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranges")
    at = at.withColumn("__range", F.shiftrightunsigned("__at", 33))
    sizes = at.groupBy("__range").agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return at.join(F.broadcast(starts), "__range").withColumn(out, F.col("__start") + inside).drop("__at", "__range", "__start")


def bits_for(rows: int, per_bucket: int = 64, least: int = 8, most: int = 40) -> int:
    """How many leading bits of a hash cut `rows` rows into buckets of about `per_bucket`."""
    return max(least, min(most, max(1, rows // per_bucket).bit_length()))


def hex_buckets(hash_col: str, rows: int) -> tuple[Column, Column]:
    """Coarse and fine buckets by leading hex digits of a hash: fine ones of a few hundred of `rows` rows at most."""
    digits = -(-bits_for(rows) // 4)
    return F.substring(hash_col, 1, digits // 2), F.substring(hash_col, 1, digits)


def bit_buckets(hash_col: str, rows: int) -> tuple[Column, Column]:
    """The same by leading bits of a signed 64-bit hash, which don't fall as the hash rises."""
    bits = bits_for(rows)
    return F.shiftright(hash_col, 64 - bits // 2), F.shiftright(hash_col, 64 - bits)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Each row of df whole, as the struct `__row`, with further columns: so no name of df's can clash with theirs."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row"), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame, *more: str, out_of: DataFrame) -> list[Column]:
    """What to select from a packed table: the columns of out_of, but those named like one of `more`, and these."""
    return [*(F.col("__row").getField(c).alias(c) for c in out_of.columns if c not in more), *(F.col(f"`{m}`") for m in more)]
