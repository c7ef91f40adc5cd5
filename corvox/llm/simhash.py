"""SimHash fingerprints, linked by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import crowded_buckets, forest, led, near_offsets, per_block
from .common import more_fields, written
from .components import connected_components
from .near_copies import deduplicated as deduplicated
from .shingles import shingle_hashes, words_of

#: Three segments: of at most 4 differing bits, one segment has at most one.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MOST_BITS = 4


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of a text: bit b is set if it is set in over half of the hashes of its word shingles.

    A-Z are lower-cased; words are runs of characters other than the blank and tab to carriage return; shingles are
    `words` neighbouring words joined by a blank, repeats counted; a shorter text is one shingle; a null text or one
    without words has fingerprint 0. The work is linear in the text.
    """
    hashes = shingle_hashes(words_of(text), words)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = counts * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", words: int = 4) -> DataFrame:
    """docs with `out`, the SimHash of `text` as a signed 64-bit number. All columns stay; `out` replaces one so named."""
    kept = docs.drop(out)
    schema = more_fields(kept, f"`{out}` long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def _signatures(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): for each fingerprint and segment its exact key and one key with each bit left out.

    The lowest bits of a key name the segment and the bit left out (63: none), so keys of different kinds never meet.
    """
    keys, rows = [], []
    every = np.arange(len(prints))
    for s, (low, width) in enumerate(SEGMENTS):
        part = (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
        for j in (*range(width), 63):
            value = part & ~np.uint64(1 << j) if j < 63 else part
            keys.append((value << np.uint64(8)) | np.uint64(s << 6 | j))
            rows.append(every)
    return np.concatenate(keys), np.concatenate(rows)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of fingerprints, each with the other columns of its row."""
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            keys, rows = _signatures(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(c.take(pa.array(rows)) for c in part.columns)], ["key", *batch.schema.names])


def _links(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """A forest over the fingerprints of each block that differ in at most MOST_BITS bits."""
    prints = table["fingerprint"].to_numpy().view(np.uint64)
    a, b = [], []
    held = 0

    def out() -> pa.RecordBatch:
        x, y = forest(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["x", "y"])

    for i, j in near_offsets(table, "key"):
        x, y = prints[i], prints[j]
        near = (np.bitwise_count(x ^ y) <= MOST_BITS) & (x != y)
        a.append(x[near])
        b.append(y[near])
        held += int(near.sum())
        if held > 1 << 19:  # bounded memory in dense blocks: what is joined already is kept as a forest
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
    if held:
        yield out()


def groups(prints: DataFrame, item: str, out: str = "component_id", block: int = 512) -> DataFrame:
    """prints(item long, fingerprint long, ...) with `out`: the smallest item that links can reach, itself included.

    Fingerprints that differ in at most 4 of 64 bits are linked. Equal fingerprints are one class before anything is
    compared, so copies cost one row each. A fingerprint is cut into 3 segments, so that of any two that link, one
    segment differs in at most one bit; each segment is posted whole and with every bit left out once, equal postings
    meet, and all meetings are verified. In crowded postings, fingerprints within 2 bits of the posting's leader are a
    ball: any two differ in at most 4 bits, so they link without being compared. The others are compared with all, in
    blocks (see blocks.block_rows); a block yields a spanning forest of its links, never its pairs. Exact: no link is
    lost, none is made up.

    Items that are null are their own null class. An empty table gives no rows.
    """
    classes = written(prints.groupBy("fingerprint").agg(F.min(item).alias("__first")), "classes")
    prints_only = classes.select("fingerprint")
    posted = prints_only.mapInArrow(_signed, "key long, fingerprint long")
    crowded = crowded_buckets(posted, "key", "fingerprint", block, "postings")
    joined = None
    if not crowded.isEmpty():
        near = led(posted, crowded, "key", "fingerprint").where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("leader"))) <= MOST_BITS // 2)
        balls = written(near.groupBy("fingerprint").agg(F.min("leader").alias("__ball")), "balls")
        joined = balls.join(balls.groupBy("__ball").agg(F.min("fingerprint").alias("x")), "__ball").where("x <> fingerprint").select("x", F.col("fingerprint").alias("y"))
        posted = prints_only.join(balls, "fingerprint", "left").mapInArrow(_signed, "key long, fingerprint long, __ball long")
    links = per_block(posted, "key", "fingerprint", block, "postings", _links, "x long, y long", crowded)
    links = (links if joined is None else links.unionByName(joined)).distinct()
    first = classes.select(F.col("fingerprint").alias("x"), F.col("__first").alias("a"))
    second = classes.select(F.col("fingerprint").alias("y"), F.col("__first").alias("b"))
    found = connected_components(links.join(first, "x").join(second, "y").select("a", "b"))
    named = classes.join(found.select(F.col("id").alias("__first"), F.col("component").alias("__found")), "__first", "left")
    named = named.select("fingerprint", F.coalesce("__found", "__first").alias(out))
    return prints.drop(out).join(named, "fingerprint")
