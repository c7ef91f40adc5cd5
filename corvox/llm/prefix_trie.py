"""The trie of conversation prefixes: digest-keyed edges, rolled up to all ancestors by pointer jumping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, placed, written

#: A conversation takes its first 0 to SHARED - 1 turns from the first of its family, FAMILY neighbouring ids.
FAMILY, SHARED = 100, 6
#: Turns of a conversation that are added up in one group, and ids that make one piece of a list of members: powers of 2.
TURN_BITS, ID_BITS = 9, 12
#: The 32-bit parts of a digest, which are added up separately: exact for up to 2**31 turns.
PARTS = tuple(f"part{k}" for k in range(8))


def turn_digest(role: Column, text: Column) -> Column:
    """A digest of a turn; the role's length keeps role and text apart."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text), 256)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, digest, chars, place): place numbers all turns by conversation and by their order in it.

    Turns are ordered by turn, null first, then role and text (by the first 64 characters, then by digest), so rows
    that repeat a turn have a stated order. A null role or text is empty; rows without conv_id have no conversation
    and are left out. Conversations are numbered by a range sort, so a long one is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(role, 1, 64).alias("role"), F.substring(text, 1, 64).alias("head"),
        turn_digest(role, text).alias("digest"), F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest"), F.col("row")]
    return placed(rows, order, "place").select("conv_id", "digest", "chars", "place")


def rebuilt(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): each conversation with its length, and its turns with their depth from 1.

    A conversation's first h turns come from the first of its family (fewer, if that has fewer; none, if there is
    none), and what follows from its own turns behind the first h. h is a hash of its id.
    """
    own = ordered.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    own = own.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")).withColumn("family", F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(FAMILY)))
    heads = own.where("conv_id = family").select("family", F.least("size", F.lit(SHARED - 1)).cast("int").alias("lent"))
    own = own.join(heads, "family", "left").withColumn("taken", F.least("h", F.coalesce("lent", F.lit(0))))
    convs = written(own.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))), "conversations")
    at = ordered.join(convs, "conv_id").withColumn("own_depth", F.col("place") - F.col("first") + 1)
    columns = ["conv_id", "length", "depth", "digest", "chars"]
    kept = at.where("own_depth > h").withColumn("depth", F.col("taken") + F.col("own_depth") - F.col("h")).select(*columns)
    lent = at.where((F.col("conv_id") == F.col("family")) & (F.col("own_depth") < SHARED)).select("family", F.col("own_depth").alias("depth"), "digest", "chars")
    taken = lent.join(convs.where("taken > 0").select("conv_id", "family", "taken", "length"), "family").where("depth <= taken").select(*columns)
    return convs.select("conv_id", "length"), kept.unionByName(taken)


def prefixes(turns: DataFrame) -> DataFrame:
    """turns(conv_id, length, depth, digest, chars) with `node` and `parent`, digests of the turns up to this one and before it.

    Each turn is hashed with its depth, and the digest of a prefix is that of the sum of its turns' hashes. Sums are
    taken inside stretches of 2**TURN_BITS turns and over the totals of stretches, so none needs a whole conversation.
    """
    hashed = F.sha2(F.concat_ws(":", "depth", "digest"), 256)
    own = ["conv_id", "length", "depth", "chars", "stretch"]
    cut = turns.withColumn("stretch", F.shiftright(F.col("depth") - 1, TURN_BITS)).withColumn("hashed", hashed)
    cut = cut.select(*own, *(F.conv(F.substring("hashed", 8 * k + 1, 8), 16, 10).cast("long").alias(p) for k, p in enumerate(PARTS)))
    # Only conversations of several stretches have totals to carry; those up to stretch s belong to stretch s + 1.
    totals = cut.where(F.col("length") > 1 << TURN_BITS).groupBy("conv_id", "stretch").agg(*(F.sum(p).alias(p) for p in PARTS))
    along = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.select("conv_id", (F.col("stretch") + 1).alias("stretch"), *(F.sum(p).over(along).alias(f"before_{p}") for p in PARTS))
    inside = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.coalesce(F.col(f"before_{p}"), F.lit(0)) + F.sum(p).over(inside)).alias(f"sum_{p}") for p in PARTS]
    upto = cut.join(totals, ["conv_id", "stretch"], "left").select(*own, *PARTS, *sums)
    key = lambda depth, sums: F.unhex(F.sha2(F.concat_ws(",", depth, *sums), 256))
    node = key(F.col("depth"), [F.col(f"sum_{p}") for p in PARTS])
    parent = key(F.col("depth") - 1, [F.col(f"sum_{p}") - F.col(p) for p in PARTS])
    return upto.select("conv_id", "length", "depth", "chars", node.alias("node"), parent.alias("parent"))


def root_key() -> Column:
    """The digest of no turns at all."""
    return F.unhex(F.sha2(F.lit(",".join("0" for _ in range(len(PARTS) + 1))), 256))


def member_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ends(node, conv_id): the SHA-256 of each node's ids, ascending, joined by commas.

    Ids are joined in pieces of 2**ID_BITS neighbouring numbers, and a node's pieces, in order, pass one by one
    through a running SHA-256: the hash is sequential by its nature, but its state has a few hundred bytes, so a node
    may have any number of members.
    """
    pieces = ends.groupBy("node", F.shiftright("conv_id", ID_BITS).alias("piece")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py().encode()
                if node == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256()
                state.update(ids)
            yield pa.RecordBatch.from_pylist([{"node": n, "ends_sha256": d} for n, d in done], schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_pylist([{"node": at, "ends_sha256": state.hexdigest()}], schema=schema)

    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    dealt = pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")
    return dealt.mapInArrow(run, "node binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, values: list[str], deepest: int) -> DataFrame:
    """(node, *values): for each node of nodes(node, parent, depth, *values) the sums over its subtree, itself included.

    Pointer jumping: in round k each node of depth 2**k at least knows its 2**k-th ancestor and the sums over its
    descendants nearer than 2**k. It gives these sums to that ancestor, and takes over that ancestor's pointer. So all
    descendants of a node arrive at it once, after as many rounds as the greatest depth has binary digits. Gifts are
    pre-aggregated, so a node may have any number of children; a round holds only the nodes deep enough for it. Each
    round is written to the shared folder.
    """
    spark = nodes.sparkSession
    gifts = [nodes.select("node", *values)]
    active = nodes.where("depth >= 1").select("node", F.col("parent").alias("up"), "depth", *values)
    reach, held = 1, []
    while reach <= deepest:
        gift = written(active.groupBy(F.col("up").alias("node")).agg(*(F.sum(v).alias(v) for v in values)), "gifts")
        gifts.append(gift)
        if 2 * reach > deepest:
            break
        got = gift.select("node", *(F.col(v).alias(f"got_{v}") for v in values))
        pointers = active.select(F.col("node").alias("up"), F.col("up").alias("next"))
        left = active.where(F.col("depth") >= 2 * reach).join(got, "node", "left")
        left = left.select("node", "up", "depth", *((F.col(v) + F.coalesce(f"got_{v}", F.lit(0))).alias(v) for v in values))
        active = written(left.join(pointers, "up").select("node", F.col("next").alias("up"), "depth", *values), "pointers")
        held.append(active)
        if len(held) > 1:
            discard(spark, held[-2])
        reach *= 2
    given = gifts[0]
    for gift in gifts[1:]:
        given = given.unionByName(gift)
    return given.groupBy("node").agg(*(F.sum(v).alias(v) for v in values))


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of turns(conv_id, turn, role, text).

    A node is a distinct sequence of first turns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs (members), n_children, n_leaves (childless nodes in its subtree), saved_tokens (over its subtree:
    members but one, times the characters of the last turn), ends_sha256 (of the ids of members that end there). A
    null turn comes first, a null role or text is empty, repeated turns follow role and text, rows without conv_id are
    left out; other columns aren't read. Without any conversation there are no rows, not even the root.
    """
    convs, turns = rebuilt(ordered_turns(turns))
    paths = written(prefixes(turns), "paths")
    root = convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), root_key().alias("node"), F.lit(None).cast("binary").alias("parent"))
    every = paths.unionByName(root)
    same = every.groupBy("node", "parent", "depth", "chars").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    same = written(same, "nodes")
    children = same.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = same.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # The root is the parent of all nodes of depth 1, so these take its id without a join.
    above = same.where("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deeper = nodes.where("depth > 1").join(above, "parent")
    least, deepest = same.agg(F.min("conv_id"), F.max("depth")).first()
    flat = nodes.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least)).cast("long"))
    nodes = deeper.unionByName(flat).withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = written(nodes, "nodes")
    sums = rolled_up(nodes, ["leaves", "saved"], deepest or 0)
    ends = every.where("depth = length").select("node", "conv_id")
    out = nodes.drop("leaves", "saved").join(sums, "node").join(member_digests(ends), "node", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")
    )
