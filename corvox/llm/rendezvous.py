"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_buckets, packed, running_total, unpacked, written

#: Shards whose hashes are written out as one expression; more are compared by an array expression.
WRITTEN_OUT = 64


def shard_of(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard, from 0, that a key falls into: the one with the highest draw weight / -ln(u(key, shard)).

    A shard's draw depends on the key, the shard and its weight alone, so a further shard takes keys only into
    itself, and one that goes gives away only its own. Shards without weight take nothing; equal draws go to the
    higher shard. A null key is a key like others.
    """
    own = list(weights) if weights is not None else [1.0] * shards
    if len(own) != shards or not any(w > 0 for w in own) or any(w < 0 for w in own):
        raise ValueError("one weight of 0 or more for each shard, and one above 0, are needed")
    text = F.coalesce(key.cast("string"), F.lit("\x00"))

    def draw(shard: Column, weight: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(text, shard), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((weight / -F.log(u)).alias("draw"), shard.alias("shard"))

    if shards <= WRITTEN_OUT:
        draws = [draw(F.lit(i), F.lit(float(w))) for i, w in enumerate(own) if w > 0]
        return (F.greatest(*draws) if len(draws) > 1 else draws[0])["shard"]
    table = F.array(*(F.lit(float(w)) for w in own))
    some = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.get(table, i) > 0)
    return F.array_max(F.transform(some, lambda i: draw(i, F.get(table, i))))["shard"]


def sharded(rows: DataFrame, key: str, shards: int, weights: Sequence[float] | None = None, order: Sequence[str] = (), count: int | None = None) -> DataFrame:
    """rows with `shard` and `slot`, the row's place in its shard from 0 without gaps; columns so named are replaced.

    Places follow a hash of the key, then `order`. No task holds a whole shard: places are counted in buckets of the
    hash, whose totals are added up. Rows that are equal in key and order take neighbouring places in any order.
    `rows` is read twice; give `count`, about how many there are, if it is known.
    """
    buckets = bit_buckets("__hash", rows.count() if count is None else count // max(1, shards))
    placed = packed(rows, shard=shard_of(F.col(key), shards, weights), __hash=F.xxhash64(F.col(key)))
    out = running_total(placed, ["shard"], buckets, ["__hash", *(f"__row.{c}" for c in (key, *order))], None, "slot")
    return out.select(*unpacked(out, "shard", "slot", out_of=rows))


def document_shards(docs: DataFrame, shards: int = 24, item: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, size, text_crc32, law, shard, slot, grown_shard) for each document.

    size: UTF-8 bytes of the text, and 8; grown_shard: where the document falls with one more shard. A null text has
    no bytes, a null item is a key like others; rows with equal items share a shard, and equal rows take its slots in
    any order. An empty table gives no rows; other columns of docs aren't read.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = docs.select(F.col(item), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    slim = written(slim, "sizes")
    out = sharded(slim, item, shards, order=["text_crc32", "size"], count=slim.count())
    return out.select(
        item, "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), "slot", shard_of(F.col(item), shards + 1).cast("int").alias("grown_shard")
    )
