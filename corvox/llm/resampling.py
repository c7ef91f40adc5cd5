"""Resampling towards a target distribution: hashed n-gram features whose CRCs are composed, never spelled out."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import more_fields, packed, placed, unpacked, written

#: Buckets of the features, the longest run of words, the words a document needs to be drawn, and how many of 100 are.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT = 10_000, 3, 20, 5
#: Words up to this many bytes are hashed side by side, longer ones one by one; bytes of texts taken together.
SIDE_BY_SIDE, BATCH_BYTES = 48, 4_000_000
#: The reflected polynomial of CRC-32; a fixed value.
POLYNOMIAL = 0xEDB88320


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """What a CRC register becomes, by its low byte, when that byte has passed."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(POLYNOMIAL), out >> 1)
    return out


def times(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A matrix over GF(2), as the images of the 32 unit vectors, times many vectors."""
    out = np.zeros_like(vectors)
    for bit in range(32):
        out ^= np.where(vectors >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


@lru_cache(maxsize=1)
def doubled_shifts() -> list[np.ndarray]:
    """The matrices that carry a CRC over 1, 2, 4, ... zero bytes, each the square of the one before."""
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    out = [byte_table()[unit & np.uint32(255)] ^ (unit >> np.uint32(8))]
    for _ in range(40):
        out.append(times(out[-1], out[-1]))
    return out


@lru_cache(maxsize=1)
def short_shifts() -> np.ndarray:
    """For each length up to SIDE_BY_SIDE + 1, its matrix as four tables of 256: [length, byte of the CRC, its value]."""
    values = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    out = [values]
    for _ in range(SIDE_BY_SIDE + 1):
        out.append(byte_table()[out[-1] & np.uint32(255)] ^ (out[-1] >> np.uint32(8)))
    return np.stack(out)


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC carried over so many bytes: crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)."""
    tables, short = short_shifts(), lengths <= SIDE_BY_SIDE + 1
    at = np.where(short, lengths, 0)
    out = tables[at, 0, crc & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= tables[at, k, crc >> np.uint32(8 * k) & np.uint32(255)]
    for i in np.flatnonzero(~short):
        one, n = crc[i : i + 1], int(lengths[i])
        for bit, matrix in enumerate(doubled_shifts()):
            if n >> bit & 1:
                one = times(matrix, one)
        out[i] = one[0]
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each byte in lower case, 0 for those that stand in no word."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    out[~word] = 0
    return out


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, bytes, text) of each word of the texts, in order: from the buffers alone, no text is cut into strings."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    first = int(offsets[0]) if len(offsets) else 0
    low = _letters()[np.frombuffer(data, np.uint8)[first : int(offsets[-1])]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = low != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = offsets.astype(np.int64) - first
    cut = bounds[:-1][bounds[:-1] < len(low)]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    # A word ends at the first byte behind it that is outside, or where the next word begins.
    over = np.flatnonzero(~inside)
    ends = over[np.searchsorted(over, starts)]
    if len(starts):
        ends[:-1] = np.minimum(ends[:-1], starts[1:])
    size = ends - starts
    owner = np.searchsorted(bounds, starts, side="right") - 1
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    table, left = byte_table(), np.flatnonzero(size <= SIDE_BY_SIDE)
    for k in range(SIDE_BY_SIDE):
        left = left[size[left] > k]
        if not len(left):
            break
        crc[left] = table[(crc[left] ^ low[starts[left] + k]) & np.uint32(255)] ^ (crc[left] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > SIDE_BY_SIDE):
        crc[i] = zlib.crc32(low[starts[i] : ends[i]].tobytes())
    return crc, size, owner


def features_of(texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of each run of 1 to `longest` words, joined by single spaces, and the words of each text.

    The CRC of a run is the CRC of the run without its last word, carried over that word and the space before it, and
    the CRC of these; so each word is read once, and each further run costs four look-ups.
    """
    crc, size, owner = words_of(texts)
    counts = np.bincount(owner, minlength=len(texts))
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    tail = shifted(space, size) ^ crc
    runs, at, whose = crc, [crc % np.uint32(buckets)], [owner]
    for n in range(2, longest + 1):
        if len(crc) < n:
            break
        runs = shifted(runs[:-1], size[n - 1 :] + 1) ^ tail[n - 1 :]
        same = owner[n - 1 :] == owner[: 1 - n]
        at.append((runs % np.uint32(buckets))[same])
        whose.append(owner[n - 1 :][same])
    return np.concatenate(at), np.concatenate(whose), counts


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of batches with at most BATCH_BYTES bytes of texts, or one text; nulls as empty texts."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text)).fill_null("")
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)) if len(texts) else []
        start, held = 0, 0
        for k, n in enumerate(sizes):
            if held and held + n > BATCH_BYTES:
                yield batch.slice(start, k - start), texts.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < len(texts):
            yield batch.slice(start), texts.slice(start)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): the features of all texts by bucket. A task sends a row for each bucket that it met, not for each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, part in _parts(batches, text):
            total += np.bincount(features_of(part, buckets, longest)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    each = texts.select(F.col(text).cast("string").alias(text)).mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> list[int]:
    """The gain of each bucket: a thousand times the log-odds of target over raw, with one more of each, rounded down.

    What comes to the driver is two numbers for each bucket, however many texts there are.
    """
    own, other = np.zeros(buckets), np.zeros(buckets)
    for counts, out in ((raw, own), (target, other)):
        for r in bucket_counts(counts, text, buckets, longest).collect():
            out[r["bucket"]] = r["n"]
    odds = (other + 1) * (own.sum() + buckets) / ((own + 1) * (other.sum() + buckets))
    return np.floor(1000 * np.log(odds)).astype(np.int64).tolist()


def weighed(docs: DataFrame, gain: list[int], text: str = "text", longest: int = LONGEST) -> DataFrame:
    """docs with n_words, n_features and weight, the sum of its features' gains; columns so named are replaced.

    A null or empty text has no words and weight 0. Nothing is shuffled.
    """
    own = ["n_words", "n_features", "weight"]
    kept = docs.drop(*own)
    rows = kept.withColumn("__text", F.col(text).cast("string"))
    schema = more_fields(kept, "n_words long, n_features long, weight long")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.float64)
        for batch, texts in _parts(batches, "__text"):
            at, whose, words = features_of(texts, len(table), longest)
            found = np.bincount(whose, minlength=len(texts))
            total = np.bincount(whose, weights=table[at], minlength=len(texts))  # whole numbers below 2**53: exact
            more = [pa.array(x.astype(np.int64)) for x in (words, found, total)]
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, *more], names)

    return rows.mapInArrow(run, schema)


def noise(item: Column, seed: int = 42) -> Column:
    """A thousand times a Gumbel draw, rounded down, from a hash of the seed and the item."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(item.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, item: str = "doc_id", text: str = "text", percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """(item, n_features, weight, score, rank) of each document: rank is 1, 2, 3, ... for those drawn, else null.

    Of the documents with at least `least` words, `percent` in 100 (rounded down) are drawn without replacement, by
    the highest weight with Gumbel noise, equal scores to the smaller item, null items last. A null or empty text has
    no features; without a target or without documents gains are those of the prior. Repeated rows are drawn like
    others, equal ones in any order. An empty table gives no rows; other columns aren't read. Ranks come from a range
    sort, so no task orders all documents.
    """
    slim = docs.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    gain = gains(slim, target, "text")
    rows = weighed(slim, gain).drop("text").withColumn("score", F.col("weight") + noise(F.col("item"), seed))
    rows = written(rows, "weighed")
    able = rows.where(F.col("n_words") >= least)
    ranked = placed(able, [F.col("score").desc(), F.col("item").asc_nulls_last()], "place")
    most = percent * able.count() // 100
    drawn = ranked.withColumn("rank", F.when(F.col("place") < most, F.col("place") + 1))
    out = drawn.drop("place").unionByName(rows.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("item").alias(item), "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, item: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """The documents drawn by `resampled`, whole, with all their columns; items must not repeat."""
    rank = resampled(docs, target, item, text, **settings).where("rank is not null").select(F.col(item).alias("__item"), "rank")
    whole = packed(docs, __item=F.col(item)).join(rank, "__item")
    return whole.select(*unpacked(whole, out_of=docs))
