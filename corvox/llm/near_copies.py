"""One document of each group of near copies: candidates by wide SimHash prints, Jaccard similarity of word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_rows, crowded_buckets, dealt, forest, led, near_offsets, per_block, whole_blocks
from .common import discard, packed, written
from .components import connected_components
from .shingles import SEED, shingle_hashes, words_of

#: Two texts are near copies if their sets of so many neighbouring words are this similar.
WORDS, LEAST = 5, 0.8
#: Of the pairs at exactly LEAST so many, at most, share no signature.
MISSED = 7e-4
#: Two sets at an angle differ in angle / pi of their bits. Sets of few shingles differ in more, as sums of few votes are
#: often near 0: those of 4 and 5 shingles, the worst at 0.8, in 0.164 of them instead of 0.151.
SMALL = 1.083
#: A segment has three blocks of at least so many bits; signatures of random prints are shared by 2 ** SHARED rows.
BLOCK_BITS, SHARED = 7, 8
#: Pairs that meet differ in so many standard deviations more bits than pairs at LEAST do, at most: in the bits that are
#: posted, and in the whole print before sets are compared.
POSTED_DEVIATIONS, DEVIATIONS = 4.0, 5.0
#: The first bits of a print, 64 in each column, go with its postings. Fewer let texts that share a passage chain.
POSTED = ("low", "bits1", "bits2", "bits3")
#: Documents in a part of a crowded group.
BLOCK = 512


@dataclass(frozen=True)
class Law:
    """How wide the prints are and how they are cut, for pairs that differ in `differ` of their bits."""

    differ: float
    block: int
    segments: int

    @property
    def words(self) -> int:
        """Numbers of 64 bits for each shingle, that have 32 votes of 2 bits each."""
        return max(2 * len(POSTED), -(-self.segments * 3 * self.block // 32))

    def most(self, bits: int, deviations: float) -> int:
        """So many of `bits` bits differ at most, if the number is not so many deviations above the mean."""
        return int(bits * self.differ + deviations * (bits * self.differ * (1 - self.differ)) ** 0.5)


def law_of(rows: int, least: float = LEAST) -> Law:
    """The law for a table of so many rows.

    Of two sets of Jaccard similarity J, the cosine is at least 2 J / (1 + J). A segment is shared if two of its three
    blocks are equal; there are as many segments as MISSED asks for.
    """
    differ = SMALL * math.acos(2 * least / (1 + least)) / math.pi
    block = max(BLOCK_BITS, math.ceil((math.log2(max(rows, 1)) - SHARED) / 2))
    same = (1 - differ) ** block
    apart = max(1e-9, 1 - 3 * same**2 * (1 - same) - same**3)
    return Law(differ, block, math.ceil(math.log(MISSED) / math.log(apart)))


def wide_print(shingles: np.ndarray, words: int) -> bytes:
    """The SimHash of a set of shingle hashes that isn't empty, of 32 * words bits.

    For each bit each shingle casts a vote of -3, -1, 1 or 3, two bits of its mixed hash; the bit is set if the sum is
    above 0. A shingle's votes are added in bytes, so for 64 shingles at a time.
    """
    steps = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    totals = np.zeros((4, words * 8), np.int64)
    for i in range(0, len(shingles), 512):
        x = shingles[i : i + 512, None] + steps
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        for k in range(4):
            votes = (x >> np.uint64(2 * k)) & np.uint64(0x0303030303030303)
            for j in range(0, len(votes), 64):
                totals[k] += votes[j : j + 64].sum(axis=0).view(np.uint8)
    return np.packbits(2 * totals > 3 * len(shingles)).tobytes()


def signatures(prints: np.ndarray, law: Law) -> np.ndarray:
    """For each print (a row of bytes) three keys for each segment: the segment with each of its blocks left out once.

    The upper bits of a key name the segment and the block left out, so keys of different kinds never meet.
    """
    bits = np.unpackbits(prints, axis=1)[:, : law.segments * 3 * law.block].reshape(len(prints), law.segments, 3, law.block)
    blocks = bits.astype(np.int64) @ (1 << np.arange(law.block))
    left = np.stack([blocks[..., j] << law.block | blocks[..., k] for j, k in ((1, 2), (0, 2), (0, 1))], axis=-1).reshape(len(prints), -1)
    return np.arange(law.segments * 3) << 2 * law.block | left


def _keyed(words: int, law: Law):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, prints = [], []
            for text in batch.column(2):
                tokens = words_of(text.as_py())
                classes.append(xxhash.xxh64_intdigest(b" ".join(tokens), SEED))
                shingles = np.unique(shingle_hashes(tokens, words))
                prints.append(wide_print(shingles, law.words) if len(shingles) else None)
            low = pa.array([p and int.from_bytes(p[:8], "little", signed=True) for p in prints], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(np.array(classes, np.uint64).view(np.int64)), low, pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "hash", "class", "low", "print"])

    return run


def _bytes(prints: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of bytes for each print."""
    return np.frombuffer(b"".join(prints.to_pylist()), np.uint8).reshape(len(prints), -1)


def _signed(law: Law):
    """The postings of (print, other columns): key, the first bits of the print, other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                prints = _bytes(part.column(0))
                keys = signatures(prints, law)
                first = np.ascontiguousarray(prints[:, : 8 * len(POSTED)]).view(np.int64)
                rows = np.repeat(np.arange(len(prints)), keys.shape[1])
                columns = [pa.array(keys.ravel()), *map(pa.array, first.T[:, rows]), *(c.take(pa.array(rows)) for c in part.columns[1:])]
                yield pa.RecordBatch.from_arrays(columns, ["key", *POSTED, *batch.schema.names[1:]])

    return run


def _meetings(law: Law):
    """A forest over the prints of each block that differ in few enough of the bits that are posted."""
    most = law.most(64 * len(POSTED), POSTED_DEVIATIONS)

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        low, *others = (table[c].to_numpy().view(np.uint64) for c in POSTED)
        a, b = [], []
        held = 0
        for i, j in near_offsets(table, "key"):
            apart = np.bitwise_count(low[i] ^ low[j]).astype(np.int64)
            near = apart > 0  # of one group already, if they share it
            for k, column in enumerate(others, 2):
                near = np.flatnonzero(near & (apart <= law.most(64 * k - 64, DEVIATIONS)))
                i, j, apart = i[near], j[near], apart[near]
                apart += np.bitwise_count(column[i] ^ column[j])
                near = apart <= most
            a.append(low[i[near]])
            b.append(low[j[near]])
            held += len(a[-1])
            if held > 1 << 19:  # bounded memory in dense blocks: what is joined already is kept as a forest
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a, b, held = [x], [y], len(x)
        if held:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    return compare


def _with_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                sets = [np.unique(shingle_hashes(words_of(t.as_py()), words)).view(np.int64) for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, pa.list_(pa.int64()))], ["near", "class", "print", "shingles"])

    return run


def _links(least: float, law: Law):
    """Links of each block: pairs with a Jaccard similarity of at least `least`, but those that earlier ones join already."""
    most = law.most(32 * law.words, DEVIATIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_blocks(batches, "near", 4096):
            near, block, part = (table[c].to_numpy() for c in ("near", "__block", "__part"))
            own = table["__own"].to_numpy()
            names = table["class"].to_numpy()
            prints = _bytes(table["print"]).view(np.uint32)
            lists = table["shingles"].combine_chunks()
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            lengths = np.diff(ends)
            cuts = np.flatnonzero((near[1:] != near[:-1]) | (block[1:] != block[:-1])) + 1
            x, y = [], []
            for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(near)]):
                joined = np.arange(first, end)
                for i in range(first, end - 1):
                    later = np.flatnonzero(joined[i + 1 - first :] != joined[i - first]) + i + 1
                    later = later[own[later] | (part[later] != part[i])]
                    n = lengths[later]
                    later = later[np.minimum(n, lengths[i]) >= least * np.maximum(n, lengths[i])]
                    later = later[np.bitwise_count(prints[later] ^ prints[i]).sum(axis=1) <= most]
                    for j in later.tolist():
                        if joined[j - first] == joined[i - first]:
                            continue
                        both = np.concatenate([values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]]])
                        both.sort()
                        shared = np.count_nonzero(both[1:] == both[:-1])
                        if shared >= least * (len(both) - shared):
                            x.append(names[i])
                            y.append(names[j])
                            joined[joined == joined[j - first]] = joined[i - first]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def candidates(prints: DataFrame, law: Law, block: int = BLOCK) -> DataFrame:
    """(low, near): the prints of prints(low, print) that a chain of meetings joins to others, and a number of their group.

    Two prints meet if they share a signature and few enough of their first 256 bits differ; `low`, the first 64 of them,
    names a print, and prints that share it are in one group. In crowded signatures, prints near the signature's leader
    are one group without being compared; the others are compared with all, in blocks (see blocks.block_rows).
    """
    columns = f"key long, {' long, '.join(POSTED)} long"
    posted = prints.select("print").mapInArrow(_signed(law), columns)
    crowded = crowded_buckets(posted, "key", "low", block, "postings")
    joined = prints.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("low").alias("a"), F.col("low").alias("b"))
    if not crowded.isEmpty():
        near = led(posted, crowded, "key", "low").where(F.bit_count(F.col("low").bitwiseXOR(F.col("leader"))) <= int(64 * law.differ))
        balls = written(near.groupBy("low").agg(F.min("leader").alias("__ball")), "balls")
        chained = balls.join(balls.groupBy("__ball").agg(F.min("low").alias("a")), "__ball").where("a <> low").select("a", F.col("low").alias("b"))
        joined = joined.unionByName(chained)
        posted = prints.join(balls, "low", "left").select("print", "__ball").mapInArrow(_signed(law), columns + ", __ball long")
    meetings = per_block(posted, "key", "low", block, "postings", _meetings(law), "a long, b long", crowded)
    found = connected_components(meetings.unionByName(joined).distinct())
    return found.select(F.col("id").alias("low"), F.col("component").alias("near"))


def deduplicated(docs: DataFrame, item: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """One document of each group of near copies: the one whose item is the smallest of its group.

    Two texts are linked if the Jaccard similarity of their sets of `words`-word shingles (see shingles.shingle_hashes)
    is at least `least`; links chain to groups. Texts with the same words are one class before anything is compared.
    Classes get a SimHash print of some hundred bits of their sets, cut into segments of three blocks; each segment is
    posted with each block left out once, equal postings meet, and classes whose meetings pass a first look at the prints
    form groups of candidates. In each, pairs whose prints are near enough are compared by their whole sets, and only
    those that reach `least` are linked. So no document goes without a linked one that stays or leads to it; how many
    pairs are missed says MISSED. Crowded signatures and groups are cut into blocks.

    A null text counts as empty. Rows with a null item are kept as they are: they can't be named as copies. Rows with
    the same item and text count as one document; of them one row stays. Other columns may have any names. An empty
    table gives no rows.
    """
    slim = docs.where(F.col(item).isNotNull()).select(F.col(item).cast("long").alias("item"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    law = law_of(slim.count(), least)
    keyed = written(slim.mapInArrow(_keyed(words, law), "item long, hash long, class long, low long, print binary"), "keyed")
    classes = written(keyed.groupBy("class").agg(F.min(F.struct("item", "hash", "low", "print")).alias("first")), "classes")
    discard(docs.sparkSession, keyed)
    prints = classes.where("first.print is not null").select("first.low", "first.print")
    members = classes.join(candidates(prints, law, block), F.col("first.low") == F.col("low")).select("near", "class", "first.item", "first.hash", "first.print")
    texts = slim.join(members, ["item", "hash"]).dropDuplicates(["item", "hash"]).select("near", "class", "print", "text")
    sets = written(texts.mapInArrow(_with_sets(words), "near long, class long, print binary, shingles array<long>"), "sets")
    links = dealt(block_rows(sets, "near", "class", block, "crowded"), "near").mapInArrow(_links(least, law), "a long, b long")
    found = connected_components(links.distinct())
    named = classes.join(found.select(F.col("id").alias("class"), "component"), "class", "left")
    leading = named.groupBy(F.coalesce("component", "class").alias("component")).agg(F.min(F.struct("first.item", "first.hash")).alias("first"))
    keep = leading.select(F.col("first.item").alias("__item"), F.col("first.hash").alias("__hash"))
    marked = packed(docs, __item=F.col(item).cast("long"), __hash=F.xxhash64(text))
    kept = marked.join(keep, ["__item", "__hash"], "left_semi").dropDuplicates(["__item", "__hash"])
    return kept.select("__row.*").unionByName(docs.where(F.col(item).isNull()))
