"""Mixing sources to target weights along a curriculum that changes over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hex_buckets, packed, running_total, unpacked, written

#: Characters that end a word.
BLANKS = r"[\x20\x09-\x0D]+"
#: Weights of the sources, in their order, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: What all sources together are to give, as a share of all sizes, and the most any source gives, as a share of its own.
SHARE, MOST = 1.5, 2.0
#: A source's share of the stream changes evenly from 1 + tilt to 1 - tilt times its mean; the tilts, in the sources' order.
TILTS = (-0.5, 0.5, 0.0)
#: The columns that `mixed` adds.
MIXED = ("size", "source_size", "target", "taken", "copies", "positions")


def word_count(text: Column) -> Column:
    """The number of words in a text, a null one included: 0."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.when(plain == "", F.lit(0)).otherwise(F.size(F.split(plain, " +"))).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, tilt) from (source, size): each source's share of SHARE times all sizes.

    Shares follow the weights; a source stops at MOST times its size and the excess goes to the others by weight,
    until none is above. That is one water level: sources are ranked by the level at which they are full, and a source
    is full if the level that remains for it and those after it would overflow it. One row for each source is all
    that the single window sees. A source of size 0 has target 0.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    nth = F.row_number().over(by_name) - 1
    cycle = lambda values: F.get(F.array(*map(F.lit, values)), F.pmod(nth, F.lit(len(values))))
    ranked = own.select("source", "source_size", cycle(WEIGHTS).alias("weight"), cycle(TILTS).alias("tilt"))
    full_at = F.col("source_size") / F.col("weight")
    every = Window.partitionBy()
    order = Window.orderBy(full_at, F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(SHARE) * F.sum("source_size").over(every) - F.lit(MOST) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = ranked.withColumn("__level", level).withColumn("__full", F.col("__level") * F.col("weight") >= F.lit(MOST) * F.col("source_size"))
    at = F.min(F.when(~F.col("__full"), F.struct(full_at.alias("at"), F.col("__level").alias("level")))).over(every)["level"]
    target = F.when(F.col("__full"), F.lit(MOST) * F.col("source_size")).otherwise(at * F.col("weight"))
    return levelled.select("source", "source_size", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"), "tilt")


def position(share: Column, tilt: Column) -> Column:
    """The time from 0 to 1 by which a source has given `share` of its target.

    Its rate is 1 + tilt * (1 - 2 t), so by t it has given t + tilt * (t - t * t); this is that, inverted.
    """
    b = F.lit(1.0) + tilt
    root = F.sqrt(F.greatest(b * b - F.lit(4.0) * tilt * share, F.lit(0.0)))
    return F.least(F.lit(1.0), F.lit(2.0) * share / (b + root))


def mixed(docs: DataFrame, item: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs with size, source_size, target, taken, copies and positions; columns so named are replaced.

    The documents of a source stand in the order of a hash of their item; the mix takes them whole, going round
    again for what the source has to give beyond its size, until the middle of a document lies beyond the target. So
    a source gives its target but for half a document, no document comes more than twice, and reruns agree. Each taken
    copy has a training position from 0 to 1: where its share of the source's target falls in the source's schedule.
    A null text has size 0, as an empty one; a null source is a source, the last. Rows with equal items and texts
    are told apart by nothing, and either may be the one that is taken. Where docs has no text, its size column counts.
    Sizes are written once, as narrow rows, for the targets and the places; `docs` is read twice. Other columns of docs
    may have any names. An empty table gives no rows.
    """
    out = _placed(docs, item, text, source)
    return out.select(*unpacked(out, *MIXED, out_of=docs))


def _placed(docs: DataFrame, item: str, text: str, source: str) -> DataFrame:
    """The packed rows of docs with the columns MIXED."""
    raw = F.coalesce(F.col(text), F.lit("")) if text in docs.columns else F.lit("")
    sized = packed(
        docs,
        __item=F.col(item),
        __text=F.crc32(raw.cast("binary")),
        size=word_count(raw) if text in docs.columns else F.col("size").cast("long"),
        __plain=F.col(source).cast("string"),
        __source=F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("")),
        __hash=F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(item).cast("string"), F.lit("")))),
    )
    slim = written(sized.select("__plain", "__source", "__hash", "size"), "sizes")
    targets = source_targets(slim.select(F.col("__plain").alias("source"), "size"))
    targets = targets.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("__source"), "source_size", "target", "tilt")
    placed = running_total(sized, ["__source"], hex_buckets("__hash", slim.count()), ["__hash", "__item", "size", "__text"], "size", "__offset", slim)
    joined = placed.join(targets, "__source")
    middle = F.col("__offset") + F.col("size") / F.lit(2.0)
    laps = [F.when(middle + k * F.col("source_size") < F.col("target"), F.lit(k)) for k in range(int(MOST))]
    at = lambda k: position((middle + k * F.col("source_size")) / F.col("target"), F.col("tilt"))
    return (
        joined.withColumn("__laps", F.array_compact(F.array(*laps)))
        .withColumn("copies", F.size("__laps"))
        .withColumn("taken", F.col("copies").cast("long") * F.col("size"))
        .withColumn("positions", F.transform("__laps", at))
        .select("__row", "__item", *MIXED)
    )


def in_training_order(docs: DataFrame, item: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The taken documents, a row for each copy, range-sorted by training position, with the columns of docs alone.

    Equal positions follow the items; see mixed for nulls and repeated rows.
    """
    out = _placed(docs, item, text, source).select("__row", "__item", F.explode("positions").alias("__position"))
    return out.orderBy("__position", "__item").select("__row.*")
