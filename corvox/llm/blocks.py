"""Comparing the members of buckets in bounded blocks, without emitting their pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


#: Up to this many crowded buckets, their counts (two numbers each) are sent to every executor.
BROADCAST_BUCKETS = 100_000


def crowded_buckets(rows: DataFrame, key: str, item: str, block: int, name: str) -> DataFrame:
    """(key, __n, __leader): the buckets of more than `block` rows, their sizes and smallest items; written."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(item).alias("__leader"))
    return written(sizes.where(F.col("__n") > block), name)


def _beside(rows: DataFrame, buckets: DataFrame, key: str, how: str = "left") -> DataFrame:
    """rows with what is known of their buckets; sent to every executor only if the buckets are few."""
    few = buckets.limit(BROADCAST_BUCKETS + 1).count() <= BROADCAST_BUCKETS
    return rows.join(F.broadcast(buckets) if few else buckets, key, how)


def led(rows: DataFrame, crowded: DataFrame, key: str, item: str) -> DataFrame:
    """(item, leader): the distinct leaders of the crowded buckets that each row is in, itself included."""
    return _beside(rows.select(key, item), crowded.select(key, F.col("__leader").alias("leader")), key, "inner").select(item, "leader").distinct()


def block_rows(rows: DataFrame, key: str, item: str, block: int, name: str, crowded: DataFrame | None = None) -> DataFrame:
    """The rows, dealt to blocks of about 2 * block rows at most.

    A bucket (the rows of one key) of up to `block` rows is one block. A larger one is cut into n parts by a hash of
    the item, and each pair of parts (a part with itself too) is a block: every two members meet in at least one, and
    no task ever gets more than two parts at once. Each row is sent n times. n is N / block for N up to 16 * block rows
    and grows with the root of N beyond, as the parts then do too: so what is sent grows with N to the power 1.5.

    Rows may have a column `__ball` (null: none): of two rows of one ball it is known how they compare, so they needn't
    meet. The largest ball of a crowded bucket has parts of its own, that meet the parts of the others alone: what is
    sent then grows with the ball, not with its square.

    Adds `__block`, the block's number, `__part`, the row's part, and `__own`, whether the block is that part with
    itself; only there are pairs of one part to be counted. `rows` is computed twice, and with balls three times. Only
    what is known of crowded buckets is joined back, by broadcast if they are few.
    """
    crowded = crowded_buckets(rows, key, item, block, name) if crowded is None else crowded
    if "__ball" in rows.columns:
        per = _beside(rows.select(key, "__ball"), crowded.select(key), key, "inner").groupBy(key, "__ball").agg(F.count(F.lit(1)).alias("__c"))
        largest = per.where("__ball is not null").groupBy(key).agg(F.max(F.struct("__c", "__ball")).alias("__l"))
        largest = largest.select(key, F.col("__l.__ball").alias("__most"), F.col("__l.__c").alias("__m"))
        crowded = written(crowded.join(largest, key, "left").select(key, "__n", "__most", F.coalesce("__m", F.lit(0)).alias("__m")), name + "-balls")
    else:
        rows = rows.withColumn("__ball", F.lit(None).cast("long"))
        crowded = crowded.select(key, "__n", F.lit(None).cast("long").alias("__most"), F.lit(0).alias("__m"))
    times = lambda n: F.ceil(F.least(n / block, 4 * F.sqrt(n / block))).cast("int")
    counted = _beside(rows, crowded, key)
    others = F.coalesce(times(F.col("__n") - F.col("__m")), F.lit(1))
    inside = F.coalesce(times(F.col("__m")), F.lit(0))
    numbered = counted.withColumn("__others", others).withColumn("__inside", inside).withColumn("__led", F.coalesce(F.col("__ball") == F.col("__most"), F.lit(False)))
    hashed = F.xxhash64(F.col(item), F.lit(7))
    part = F.when(F.col("__led"), F.col("__others") + F.pmod(hashed, F.greatest(F.col("__inside"), F.lit(1)))).otherwise(F.pmod(hashed, F.greatest(F.col("__others"), F.lit(1))))
    last = F.when(F.col("__led"), F.col("__others")).otherwise(F.col("__others") + F.col("__inside")) - 1
    none = F.array().cast("array<int>")
    return (
        numbered.withColumn("__part", part.cast("int"))
        .withColumn("__other", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(none)))
        .withColumn("__block", F.least("__part", "__other").cast("long") * (F.col("__others") + F.col("__inside")) + F.greatest("__part", "__other"))
        .withColumn("__own", F.col("__part") == F.col("__other"))
        .drop("__n", "__m", "__most", "__other", "__others", "__inside", "__led")
    )


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows with those of each block next to one another in one task."""
    return rows.repartition(key, "__block").sortWithinPartitions(key, "__block")


def whole_blocks(batches: Iterator[pa.RecordBatch], key: str, most: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of at least `most` rows (but the last) that end where a block ends."""
    kept: list = []
    held = 0
    for batch in batches:
        kept.append(batch)
        held += batch.num_rows
        if held < most:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        k, b = table[key].to_numpy(), table["__block"].to_numpy()
        new = np.flatnonzero((k[1:] != k[:-1]) | (b[1:] != b[:-1]))
        if len(new):
            yield table.slice(0, new[-1] + 1)
            rest = table.slice(new[-1] + 1)
            kept, held = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(kept).combine_chunks()


def near_offsets(table: pa.Table, key: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): the rows of pairs in the same block, not of the same ball; over a bucket's blocks every such pair comes once."""
    key, block, part = table[key].to_numpy(), table["__block"].to_numpy(), table["__part"].to_numpy()
    own = table["__own"].combine_chunks().to_numpy(zero_copy_only=False)
    ball = pc.fill_null(table["__ball"].combine_chunks(), np.iinfo(np.int64).min).to_numpy()
    free = ball == np.iinfo(np.int64).min
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    left = np.repeat(size, size) - (np.arange(n) - np.repeat(start, size)) - 1  # rows after this one in its block
    rows = np.flatnonzero(left >= 1)
    d = 1
    while len(rows):
        counted = rows[(own[rows] | (part[rows] != part[rows + d])) & (free[rows] | (ball[rows] != ball[rows + d]))]
        if len(counted):
            yield counted, counted + d
        d += 1
        rows = rows[left[rows] >= d]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join the same nodes as the pairs (a, b) do, one less than nodes in each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while True:
        low = np.minimum(up[i], up[j])
        new = up.copy()
        np.minimum.at(new, up[i], low)
        np.minimum.at(new, up[j], low)
        new = new[new]
        if np.array_equal(new, up):
            break
        up = new
    moved = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[up[moved]], nodes[moved]


def per_block(rows: DataFrame, key: str, item: str, block: int, name: str, compare: Callable, schema: str, crowded: DataFrame | None = None) -> DataFrame:
    """compare(table of whole blocks) -> RecordBatch, over all blocks of the buckets of `rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_blocks(batches, key):
            yield from compare(table)

    return dealt(block_rows(rows, key, item, block, name, crowded), key).mapInArrow(run, schema)
