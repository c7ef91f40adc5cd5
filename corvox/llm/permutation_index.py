"""Approximate nearest neighbours by a permutation index: pivot orders, inverted files, footrule distance, rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import more_fields, written
from .vectors import matrix, usable

#: Pivots, how many of them (the nearest) a row and a query are represented by, and from how many rows, at most, pivots
#: are chosen and routes are fitted.
PIVOTS, ORDERED, ASKED, SAMPLE = 1024, 128, 96, 4096
#: Of a query's neighbours in the sample, this share lies in the cells that it is sent to.
ROUTED = 0.98
#: Rows that are reranked: this share of those in the blocks a query visits, and so many times k.
RERANKED, TIMES = 0.06, 10
#: Rows of a block are so many times the root of all rows, up to a bound for a worker's memory; queries at a time.
ROOT, MOST_ROWS, AT_ONCE = 14, 32_768, 256


class Pivots:
    """The pivots, chosen out of a bounded sample, and the cells of the first `cells` of them.

    Vectors are compared by inner product, so each gets one more component that brings all to the length `longest`;
    nearest in distance is then largest in inner product. A query has 0 there. A row belongs to the cell of the nearest
    of the first pivots; a query is sent to the cells of its `routes` nearest ones. routes is fitted on the sample: its
    neighbours there are further than those among all rows, which lie in nearer cells.
    """

    def __init__(self, sample: np.ndarray, longest: float, cells: int, k: int) -> None:
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        taken: list[int] = []
        for i in range(len(sample)):  # none nearly parallel to another while there are others
            if len(taken) < PIVOTS and (not taken or (unit[taken] @ unit[i]).max() < 0.9):
                taken.append(i)
        rest = [i for i in range(len(sample)) if i not in set(taken)]
        self.x, self.longest = sample[(taken + rest)[:PIVOTS]], longest
        self.more = self._more(self.x)
        self.cells = max(1, min(cells, len(self.x)))
        asked = sample[: max(1, SAMPLE // 16)]
        score = asked @ sample.T
        score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
        near = np.argsort(-score, axis=1, kind="stable")[:, : min(k, max(1, len(sample) - 1))]
        nth = np.argsort(self.routes_of(asked, self.cells), axis=1)  # the place of each cell in a query's order
        ranks = np.sort(np.take_along_axis(nth, self.cell_of(sample)[near], 1).ravel())
        self.routes = int(ranks[min(len(ranks) - 1, math.ceil(ROUTED * len(ranks)) - 1)]) + 1

    def _more(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest**2 - np.einsum("ij,ij->i", x, x), 0))

    def nearness(self, x: np.ndarray, first: int | None = None) -> np.ndarray:
        """[rows, pivots]: inner products of the lengthened vectors."""
        return x @ self.x[:first].T + self._more(x)[:, None] * self.more[:first]

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        return self.nearness(x, self.cells).argmax(axis=1)

    def routes_of(self, q: np.ndarray, count: int | None = None) -> np.ndarray:
        """[queries, count]: the cells of each query, nearest first."""
        return np.argsort(-(q @ self.x[: self.cells].T), axis=1, kind="stable")[:, : count or self.routes]

    def orders_of(self, nearness: np.ndarray, count: int) -> np.ndarray:
        """[rows, count]: the numbers of the nearest pivots, nearest first."""
        count = min(count, len(self.x))
        some = np.argpartition(-nearness, count - 1, axis=1)[:, :count]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(nearness, some, 1), axis=1, kind="stable"), 1)


class Block:
    """The inverted files of one block: for each pivot, the rows that have it among their nearest ones, and where.

    With K the length of the orders, a pivot that two orders have at places i and j brings them nearer, in footrule
    distance, by 2 * min(K - i, K - j) than one that only one of them has. So only the files of the query's pivots are
    read, the gains of the rows in them are added up, and no others are candidates.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: Pivots) -> None:
        self.ids, self.x, self.pivots = ids, x, pivots
        near = np.concatenate([pivots.orders_of(pivots.nearness(x[i : i + 2048]), ORDERED) for i in range(0, len(x), 2048)])
        k = near.shape[1]
        order = np.argsort(near.ravel(), kind="stable")
        self.rows = (order // k).astype(np.int32)
        self.gains = (k - order % k).astype(np.int16)
        self.ends = np.searchsorted(near.ravel()[order], np.arange(len(pivots.x) + 1))
        self.own = k - np.arange(min(ASKED, k), dtype=np.int16)

    def search(self, ids: np.ndarray, q: np.ndarray, k: int, reranked: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query ids, row ids, inner products): of each query the k best of the `reranked` rows nearest in footrule."""
        for item, vector, order in zip(ids, q, self.pivots.orders_of(q @ self.pivots.x.T, ASKED)):
            lists = [slice(i, j) for i, j in zip(self.ends[order], self.ends[order + 1])]
            rows = np.concatenate([self.rows[s] for s in lists])
            own = np.repeat(self.own, self.ends[order + 1] - self.ends[order])
            gain = np.bincount(rows, np.minimum(np.concatenate([self.gains[s] for s in lists]), own), len(self.ids))
            few = min(len(self.ids), reranked + 1)  # the query itself may be one of them
            at = np.argpartition(-gain, few - 1)[:few]
            at = at[(gain[at] > 0) & (self.ids[at] != item)]
            score = self.x[at] @ vector
            best = np.lexsort((self.ids[at], -score))[:k]
            yield np.full(len(best), item), self.ids[at[best]], score[best]


def search(rows: DataFrame, is_query: Column, item: str, vector: str, k: int = 20) -> DataFrame:
    """(query_id, rank, item, score): for each query row the k other rows with the largest inner products found.

    Nearest first, ties to the smaller item; all candidates if there are fewer than k. Every row is indexed, in the cell
    of its nearest pivot; crowded cells are cut into blocks of a bounded number of rows. A query visits the blocks of
    the cells of its nearest pivots, takes its best k in each, and the best k of all stay. Only the pivots and the
    number of cells to visit come from a sample (SAMPLE rows). Of equal vectors, the k + 1 smallest items are
    candidates: more can't be among the k nearest of any query, as ties go to smaller items.

    is_query is a condition on the columns of rows. Rows with a null item or a vector that is null, zero or holds null or
    non-finite components take no part; an empty table gives no rows. Rows that share an item are all candidates, but
    not for queries with that item.
    """
    asked = rows.where(F.coalesce(is_query, F.lit(False)) & F.col(item).isNotNull()).select(F.col(item).cast("long").alias("item")).distinct()
    own = usable(rows, item, vector)
    facts = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("sqrt(aggregate(vector, 0D, (s, v) -> s + double(v) * double(v)))")).alias("longest")).first()
    sample = own.orderBy(F.xxhash64(F.lit("pivot"), "item"), "item").limit(SAMPLE).select("vector").collect()
    fields = "query_id long, item long, score double"
    if not sample:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, item long, score double")
    most = min(MOST_ROWS, math.ceil(ROOT * math.sqrt(facts["n"])))
    pivots = Pivots(np.array([r["vector"] for r in sample], np.float64), facts["longest"], round(facts["n"] / most), k)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = pivots.cell_of(matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["item", "vector", "cell"])

    smallest = Window.partitionBy("vector").orderBy("item")
    kept = own.withColumn("__nth", F.dense_rank().over(smallest)).where(F.col("__nth") <= k + 1).drop("__nth")
    indexed = written(kept.mapInArrow(located, more_fields(own, "cell int")), "cells")
    counts = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}  # a row for each cell, PIVOTS at most
    parts = [math.ceil(counts.get(c, 0) / most) for c in range(pivots.cells)]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pivots.routes_of(matrix(batch.column(1))) if batch.num_rows else np.zeros((0, 1), int)
            blocks = [[(int(c) << 32) + p for c in own for p in range(parts[c])] for own in cells]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.list_(pa.int64()))], ["item", "vector", "blocks"])

    part = F.pmod(F.xxhash64("item"), F.get(F.array(*(F.lit(max(1, p)) for p in parts)), F.col("cell")))
    data = indexed.select((F.shiftleft(F.col("cell").cast("long"), 32) + part).alias("block"), F.lit(0).alias("kind"), "item", "vector", F.lit(0).alias("visits"))
    queries = own.join(asked, "item", "left_semi").mapInArrow(sent, more_fields(own, "blocks array<long>"))
    queries = queries.select(F.explode("blocks").alias("block"), F.lit(1).alias("kind"), "item", "vector", F.size("blocks").alias("visits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, at, held = None, None, []
        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for i, j in zip([0, *new], [*new, len(block)]):
                if i == j:
                    continue
                ids, x = batch.column(2).slice(i, j - i).to_numpy(), matrix(batch.column(3).slice(i, j - i))
                if at != block[i]:
                    index, at, held = None, block[i], []
                if kind[i] == 0:
                    held.append((ids, x))
                    continue
                if index is None and held:
                    index = Block(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]), pivots)
                    held = []
                if index is None:
                    continue
                reranked = math.ceil(RERANKED * len(index.ids) + TIMES * k / batch.column(4)[i].as_py())
                for m in range(0, len(ids), AT_ONCE):
                    found = list(index.search(ids[m : m + AT_ONCE], x[m : m + AT_ONCE], k, reranked))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "item", "score"])

    dealt = data.unionByName(queries).repartition("block").sortWithinPartitions("block", "kind", "visits")
    found = written(dealt.mapInArrow(run, fields), "found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "item", "score")
