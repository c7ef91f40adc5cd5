"""Embedding near-dedup: randomised-rotation binary codes with correction factors decide what is compared exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import crowded_buckets, forest, led, near_offsets, per_block, whole_blocks
from .common import written
from .components import connected_components
from .vectors import matrix, units, usable

#: The chance that a pair exactly at the threshold meets in no table, and how many standard errors an estimate may be off.
MISS, ERRORS = 1e-4, 4.0
SEED = 20_240_601


class Codes:
    """Sign codes of vectors under seeded random rotations.

    The first rotation's code is the estimator: with s the signs over sqrt(D) and f = <s, Rx> the stored correction
    factor, <s, Ry> / f is an unbiased estimate of <x, y> for a random rotation R, with a standard error of at most
    sqrt((1 - f^2) / f^2 / (D - 1)). All rotations' signs, cut into `tables` keys of `bits` bits, say which vectors meet.
    """

    def __init__(self, dim: int, tables: int, bits: int) -> None:
        self.dim, self.tables, self.bits = dim, tables, bits
        rng = np.random.default_rng(SEED)
        need = -(-tables * bits // dim)
        self.rotations = [self._rotation(rng, dim) for _ in range(max(1, need))]

    @staticmethod
    def _rotation(rng: np.random.Generator, dim: int) -> np.ndarray:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        return q * np.sign(np.diag(r))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """[n, tables]: the keys of unit vectors; the table's number stands above the bits."""
        signs = np.concatenate([x @ r.T > 0 for r in self.rotations], axis=1)[:, : self.tables * self.bits]
        cut = signs.reshape(len(x), self.tables, self.bits).astype(np.int64)
        return (cut << np.arange(self.bits)).sum(axis=2) | (np.arange(self.tables, dtype=np.int64) << 32)

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rotated vectors as 8-bit integers, their unit, correction factor)."""
        y = x @ self.rotations[0].T
        unit = np.abs(y).max(axis=1) / 127.0
        return np.rint(y / unit[:, None]).astype(np.int8), unit, np.abs(y).sum(axis=1) / math.sqrt(self.dim)


def plan(vectors: int, threshold: float) -> tuple[int, int]:
    """(tables, bits): keys of about 32 vectors each on random data, and tables enough that MISS holds at the threshold."""
    bits = max(4, min(30, vectors.bit_length() - 6))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(MISS) / math.log1p(-meet)), bits


def _balls(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(id, __ball): for each class the smallest of the leaders within half the angle of the threshold, if there is one.

    By the triangle inequality of angles any two classes of one ball have a cosine of at least the threshold; the margin
    of 1e-9 is far above the rounding of the inner products.
    """
    least = math.cos(math.acos(threshold) / 2) + 1e-9
    both = pairs.join(classes.select("id", "vector"), "id").join(classes.select(F.col("id").alias("leader"), F.col("vector").alias("centre")), "leader")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = np.einsum("ij,ij->i", units(matrix(batch.column(2))), units(matrix(batch.column(3)))) >= least if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["id", "leader"]).filter(pa.array(close))

    found = both.select("id", "leader", "vector", "centre").mapInArrow(near, "id long, leader long")
    return written(found.groupBy("id").agg(F.min("leader").alias("__ball")), "balls")


def linked(rows: DataFrame, item: str, vector: str, threshold: float = 0.9, block: int = 512) -> DataFrame:
    """(item, n_links, component_id, kept) for every row: links are pairs with cosine >= threshold, in double precision.

    Equal vectors are one class, with a count, before anything is compared. Classes meet by sign keys of random
    rotations, in bounded blocks (see blocks.block_rows). In a crowded bucket, the classes within half the threshold's
    angle of its leader are a ball: any two of them link, which is counted without comparing them (see _balls). In a block, codes and correction factors estimate all inner
    products with confidence bounds; only vectors with a pair that the bounds leave open are fetched, and their pairs
    recomputed exactly. A pair counts in the first table where it meets; blocks yield counts and spanning forests of
    links, never the pairs. A pair at the threshold is missed with a chance of MISS; closer ones far less.

    Rows whose vector is null, zero or holds null or non-finite components have no links and are their own component.
    A null item is kept with no links and a null component. Of rows with one item and several vectors, each is compared;
    they share a component, and a row each is returned. An empty table gives no rows.
    """
    spark = rows.sparkSession
    ids = rows.select(F.col(item).cast("long").alias("item"))
    own = usable(rows, item, vector)
    classes = own.groupBy("vector").agg(F.min("item").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "classes")
    count = classes.count()
    none = ids.select("item", F.lit(0).cast("long").alias("n_links"), F.col("item").alias("component_id"))
    if count == 0:
        return none.withColumn("kept", F.lit(True))
    dim = classes.select(F.size("vector").alias("d")).first()["d"]
    codes = Codes(dim, *plan(count, threshold))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys = codes.keys(units(matrix(part.column(1))))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column(0).take(pa.array(np.repeat(np.arange(len(keys)), codes.tables)))], ["key", "id"])

    keys_only = classes.select("id", "vector").mapInArrow(keyed, "key long, id long")
    crowded = crowded_buckets(keys_only, "key", "id", block, "crowded")
    members = _balls(led(keys_only, crowded, "key", "id"), classes, threshold) if not crowded.isEmpty() else None
    if members is not None:
        classes = written(classes.join(members, "id", "left"), "classes")
    else:
        classes = classes.withColumn("__ball", F.lit(None).cast("long"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = units(matrix(part.column(1)))
                small, unit, factor = codes.code(x)
                t = codes.tables
                packed = pa.array([r.tobytes() for r in small], pa.binary())
                every = pa.array(np.repeat(np.arange(len(x)), t))
                columns = [pa.array(codes.keys(x).ravel()), part.column(0), packed, pa.array(unit), pa.array(factor), part.column(2)]
                yield pa.RecordBatch.from_arrays([columns[0], *(c.take(every) for c in columns[1:])], ["key", "id", "code", "unit", "factor", "__ball"])

    posted = classes.select("id", "vector", "__ball").mapInArrow(post, "key long, id long, code binary, unit double, factor double, __ball long")

    def estimate(table: pa.Table) -> Iterator[pa.RecordBatch]:
        small = np.frombuffer(b"".join(table["code"].to_pylist()), np.int8).reshape(table.num_rows, dim)
        unit, factor = table["unit"].to_numpy(), table["factor"].to_numpy()
        signs = np.where(small >= 0, 1, -1).astype(np.int8)
        error = ERRORS * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(1, dim - 1))
        open_ = np.zeros(table.num_rows, bool)
        for rows_i, rows_j in near_offsets(table, "key"):
            for at in range(0, len(rows_i), 1 << 16):
                i, j = rows_i[at : at + (1 << 16)], rows_j[at : at + (1 << 16)]
                one = np.einsum("ij,ij->i", signs[i], small[j], dtype=np.int32) * unit[j] / (factor[i] * math.sqrt(dim))
                two = np.einsum("ij,ij->i", signs[j], small[i], dtype=np.int32) * unit[i] / (factor[j] * math.sqrt(dim))
                left = (one + two) / 2 + (error[i] + error[j]) / 2 + 0.01 >= threshold  # 0.01: the 8-bit rounding
                open_[i[left]] = True
                open_[j[left]] = True
        if open_.any():
            yield table.select(["key", "__block", "__part", "__own", "__ball", "id"]).filter(pa.array(open_)).combine_chunks().to_batches()[0]

    fields = "key long, __block long, __part int, __own boolean, __ball long, id long"
    undecided = written(per_block(posted, "key", "id", block, "crowded", estimate, fields, crowded), "undecided")
    fetched = undecided.join(classes.select("id", "n", "vector"), "id")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_blocks(batches, "key", 1 << 14):
            ids_, n = table["id"].to_numpy(), table["n"].to_numpy()
            x = units(matrix(table["vector"]))
            keys, mine = codes.keys(x), table["key"].to_numpy() >> 32
            before = np.arange(codes.tables) < mine[:, None]
            links = np.zeros(len(x), np.int64)
            a, b = [], []
            for rows_i, rows_j in near_offsets(table, "key"):
                for at in range(0, len(rows_i), 1 << 14):
                    i, j = rows_i[at : at + (1 << 14)], rows_j[at : at + (1 << 14)]
                    near = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
                    i, j = i[near], j[near]
                    first = ~((keys[i] == keys[j]) & before[i]).any(axis=1)
                    i, j = i[first], j[first]
                    np.add.at(links, i, n[j])
                    np.add.at(links, j, n[i])
                    a.append(ids_[i])
                    b.append(ids_[j])
                    if sum(map(len, a)) > 1 << 19:
                        a, b = ([v] for v in forest(np.concatenate(a), np.concatenate(b)))
            if a:
                x_, y_ = forest(np.concatenate(a), np.concatenate(b))
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x_, ids_[some]])), pa.array(np.concatenate([y_, ids_[some]])), pa.array(np.concatenate([np.zeros(len(x_), np.int64), links[some]]))],
                    ["a", "b", "links"],
                )

    dealt = fetched.repartition("key", "__block").sortWithinPartitions("key", "__block")
    dealt = dealt.select("key", "__block", "__part", "__own", "__ball", "id", "n", "vector")
    found = written(dealt.mapInArrow(exact, "a long, b long, links long"), "found")
    counts, edges = found.where("links > 0").select(F.col("a").alias("id"), "links"), found.where("links = 0").select("a", "b")
    if members is not None:
        inside = classes.where("__ball is not null")
        sizes = inside.groupBy("__ball").agg(F.sum("n").alias("__total"), F.min("id").alias("a"))
        inside = inside.join(sizes, "__ball")
        counts = counts.unionByName(inside.select("id", (F.col("__total") - F.col("n")).alias("links")))
        edges = edges.unionByName(inside.select("a", F.col("id").alias("b")))
    counts = counts.groupBy("id").agg(F.sum("links").alias("links"))
    group = connected_components(edges.distinct())
    told = classes.select("vector", "id", "n").join(counts, "id", "left").join(group, "id", "left")
    told = told.select("vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    good = own.join(told, "vector").select("item", "n_links", "component_id")
    bad = rows.select(F.col(item).cast("long").alias("item"), F.col(vector).alias("vector"))
    x = F.col("vector")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0) & (F.size(x) == dim)
    bad = bad.where(~F.coalesce(ok, F.lit(False)) | F.col("item").isNull())
    out = good.unionByName(bad.select("item", F.lit(0).cast("long").alias("n_links"), F.col("item").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("item") == F.col("component_id"), F.lit(True)))
