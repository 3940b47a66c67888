"""The tree of conversation prefixes, totalled by parallel contraction.

A node is a distinct sequence of first turns. Nodes are told by sums of hashes of (place, turn), which
are prefix sums over ordered rows, so that no conversation is gathered whole, however long. A node's
name is the least conversation that starts with it, with its depth.

Subtree totals come by contraction in rounds of joins. A round takes out of the tree nodes with one
child whose depth has a bit that their parent's depth lacks, so that no two neighbours go at once
(compress), and then all leaves (rake); what they hold goes to their parents. Over the rounds the
bit moves up, so a chain of any length is halved by each. Then the compressed nodes are put back, the
last ones first: the total of one is what it held and the total of its child.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, numbered, ship, small_enough, word_count

# 160 bits of a prefix: sums of 40-bit hashes, so that eight million turns do not overflow
LANES, LANE_BITS = 4, 40
NOTHING = hashlib.sha256(b"").hexdigest()
# depths are told apart by so many bits before the rounds start again at the lowest
DEPTH_BITS = 24


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``role``, ``text`` (null: empty), ``turn``; rows without a conversation take no part."""
    c = conversations
    return c.select(
        c["conv_id"].cast("long").alias("conv"),
        c["turn"].alias("turn"),
        F.coalesce(c["role"], F.lit("")).alias("role"),
        F.coalesce(c["text"], F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")


def _hashed(turns: DataFrame) -> DataFrame:
    """Turns in order: ``conv``, ``place`` (from 0), two hashes of role and text, ``words``."""
    content = [F.xxhash64(F.lit(seed), "role", "text").alias(f"t{seed}") for seed in (1, 2)]
    wide = turns.select("conv", "turn", "role", "text", *content, word_count(F.col("text")).alias("words"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return numbered(wide, order, ["conv", "t1", "t2", "words"])


def with_shared_starts(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt so that those of a group start alike: ``conv``, ``depth`` (from 1), hashes, words.

    Conversation c takes the first h turns of conversation c - c % ``group``, all if that has fewer and
    none if it is missing, and then its own after its first h; h = crc32(decimal c) % ``most``. A row of
    depth 0 stands for every conversation, also for one that has no turns left.
    """
    rows = _hashed(_turns(conversations))
    sizes = checkpointed(rows.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("turns")))
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    heads = sizes.select("conv", taken.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"), "first")
    bases = sizes.select(F.col("conv").alias("base"), F.col("turns").alias("there"))
    heads = checkpointed(heads.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("there", F.lit(0)))))
    placed = rows.join(small_enough(heads), "conv").withColumn("place", F.col("at") - F.col("first"))
    columns = ["conv", "depth", "t1", "t2", "words"]
    own = placed.where("place >= h").withColumn("depth", F.col("shared") + F.col("place") - F.col("h") + 1).select(*columns)
    # a conversation's first turns go to the conversations of its group, which are fewer than ``group``
    starts = placed.where(F.col("place") < most - 1).select(F.col("conv").alias("base"), "place", "t1", "t2", "words")
    lent = (
        heads.where("shared > 0").select("conv", "base", "shared").join(starts, "base").where("place < shared")
        .withColumn("depth", F.col("place") + 1).select(*columns)
    )
    nothing = F.lit(0).cast("long")
    roots = sizes.select("conv", *[nothing.alias(c) for c in columns[1:]])
    return own.unionByName(lent).unionByName(roots)


def as_they_are(conversations: DataFrame) -> DataFrame:
    """Conversations in their own order, for :func:`prefix_tree`."""
    rows = _hashed(_turns(conversations))
    first = checkpointed(rows.groupBy("conv").agg(F.min("at").alias("first")))
    nothing = F.lit(0).cast("long")
    own = rows.join(small_enough(first), "conv").withColumn("depth", F.col("at") - F.col("first") + 1)
    roots = first.select("conv", *[nothing.alias(c) for c in ("depth", "t1", "t2", "words")])
    return own.select("conv", "depth", "t1", "t2", "words").unionByName(roots)


def _prefixed(turns: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``words``, keys of the prefix (``k1``, ``k2``) and of the one before (``p1``, ``p2``).

    The sums run inside a partition and carry on from the partitions before, so that a long
    conversation may lie in many.
    """
    mask = F.lit((1 << LANE_BITS) - 1)
    term = [F.xxhash64(F.lit(i), "depth", "t1", "t2").bitwiseAND(mask) for i in range(LANES)]
    lanes = [F.when(F.col("depth") > 0, t).otherwise(0).alias(f"l{i}") for i, t in enumerate(term)]
    placed = turns.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    part = F.shiftright(F.monotonically_increasing_id(), 33).alias("part")
    rows = checkpointed(placed.select("conv", "depth", "words", part, *lanes))
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("conv", "part").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LANES)])
    # only a conversation that begins in an earlier partition has anything to carry: one a partition
    carried = carried.select("conv", "part", *[F.sum(f"l{i}").over(ahead).alias(f"c{i}") for i in range(LANES)]).where("c0 IS NOT NULL")
    carried = F.broadcast(checkpointed(carried))
    run = Window.partitionBy("part", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(carried, ["conv", "part"], "left")
    sums = [(F.sum(f"l{i}").over(run) + F.coalesce(f"c{i}", F.lit(0))).alias(f"s{i}") for i in range(LANES)]
    summed = joined.select("conv", "depth", "words", *[f"l{i}" for i in range(LANES)], *sums)

    def key(depth: Column, *of: Column) -> list[Column]:
        return [F.xxhash64(F.lit(seed), depth, *of) for seed in (1, 2)]

    now = key(F.col("depth"), *[F.col(f"s{i}") for i in range(LANES)])
    before = key(F.col("depth") - 1, *[F.col(f"s{i}") - F.col(f"l{i}") for i in range(LANES)])
    names = ["k1", "k2", "p1", "p2"]
    return summed.select("conv", "depth", "words", *[c.alias(n) for c, n in zip([*now, *before], names)])


def prefix_tree(turns: DataFrame) -> DataFrame:
    """Per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    ``turns`` comes from :func:`with_shared_starts` or :func:`as_they_are`. Turns are in the order of
    ``turn``, null first, and those of the same turn in the order of role and text; null role or text
    is empty. ``saved_tokens`` sums over the subtree, top included, the members but one times the words of
    the node's last text. ``ends_sha256`` hashes the ids of the conversations that end in the node; they
    stream through the task of their node in order, so it holds a hash and not the ids. Repeated rows
    are turns like any other. Rows without a ``conv_id`` take no part; an empty table gives an
    empty result; other columns are not read.
    """
    rows = checkpointed(_prefixed(turns))
    found = rows.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2"),
    )
    found = checkpointed(found)
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    inner = found.where("depth > 0").join(small_enough(checkpointed(parents)), ["depth", "p1", "p2"])
    roots = found.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))
    columns = ["conv", "depth", "parent", "n_convs", "words", "k1", "k2"]
    nodes = inner.select(*columns).unionByName(roots.select(*columns))
    kids = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    nodes = checkpointed(nodes.join(kids, ["conv", "depth"], "left").fillna(0, ["kids"]))
    own = nodes.select(
        "conv", "depth", F.col("parent").alias("up_conv"), (F.col("depth") - 1).alias("up_depth"), "kids",
        (F.col("kids") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    totals = subtree_totals(own)
    ends = _ends(rows, nodes)
    out = nodes.join(totals, ["conv", "depth"]).join(ends, ["conv", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """``conv``, ``depth`` and the sums of ``leaves`` and ``saved`` over the subtree of every node.

    ``nodes``: conv, depth, up_conv, up_depth (the parent; null at a root), kids, leaves, saved. Every
    round is written to the checkpoint folder; ends when only roots are left.
    """
    held = ["leaves", "saved"]
    alive, raked, taken = nodes, [], []
    handed_out = F.col("out_conv").isNotNull()
    turn = 0
    while not alive.where("up_conv IS NOT NULL").isEmpty():
        bit = turn % DEPTH_BITS
        turn += 1

        def has(depth: str) -> Column:
            return F.shiftright(F.col(depth), bit).bitwiseAND(F.lit(1)) == 1

        alive = alive.withColumn("out", F.coalesce((F.col("kids") == 1) & has("depth") & ~has("up_depth"), F.lit(False)))
        # compress: the only child of a node that goes is handed to the node's parent
        out = alive.where("out").select(
            F.col("conv").alias("up_conv"), F.col("depth").alias("up_depth"), F.col("up_conv").alias("new_conv"),
            F.col("up_depth").alias("new_depth"), *[F.col(h).alias(f"out_{h}") for h in held],
        )
        left = alive.where("NOT out").drop("out").join(out, ["up_conv", "up_depth"], "left")
        handed = F.col("new_conv").isNotNull()
        left = left.select(
            "conv", "depth", "kids", *held,
            F.coalesce("new_conv", "up_conv").alias("up_conv"), F.coalesce("new_depth", "up_depth").alias("up_depth"),
            F.when(handed, F.col("up_conv")).alias("out_conv"), F.when(handed, F.col("up_depth")).alias("out_depth"),
            *[f"out_{h}" for h in held],
        )
        # rake: leaves give what they hold to their parents, and so do the nodes that went
        is_leaf = (F.col("kids") == 0) & F.col("up_conv").isNotNull()
        gives = left.where(is_leaf).select("up_conv", "up_depth", *held, F.lit(1).alias("n"))
        gives = gives.unionByName(
            left.where(handed_out).select("up_conv", "up_depth", *[F.col(f"out_{h}").alias(h) for h in held], F.lit(0).alias("n"))
        )
        given = gives.groupBy(F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth")).agg(
            *[F.sum(h).alias(f"got_{h}") for h in held], F.sum("n").alias("n")
        )
        after = left.withColumn("leaf", is_leaf).join(given, ["conv", "depth"], "left")
        after = checkpointed(
            after.select(
                "conv", "depth", "up_conv", "up_depth", "leaf", (F.col("kids") - F.coalesce("n", F.lit(0))).alias("kids"),
                *[(F.col(h) + F.coalesce(f"got_{h}", F.lit(0))).alias(h) for h in held],
                "out_conv", "out_depth", *[f"out_{h}" for h in held],
            )
        )
        raked.append(after.where("leaf").select("conv", "depth", *held))
        taken.append(after.where(handed_out).select("conv", "depth", "out_conv", "out_depth", *[f"out_{h}" for h in held]))
        alive = after.where("NOT leaf").select("conv", "depth", "up_conv", "up_depth", "kids", *held)
    # expand: a node that went has what it held and all that its child has
    totals = alive.select("conv", "depth", *held)
    for known, out in zip(reversed(raked), reversed(taken)):
        totals = totals.unionByName(known)
        if out.isEmpty():
            continue
        back = out.join(totals, ["conv", "depth"]).select(
            F.col("out_conv").alias("conv"), F.col("out_depth").alias("depth"), *[(F.col(h) + F.col(f"out_{h}")).alias(h) for h in held]
        )
        totals = totals.unionByName(checkpointed(back))
    return totals


def _ends(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``conv``, ``depth`` of nodes in which conversations end, and the hash of their ids in order."""
    last = rows.groupBy("conv").agg(F.max(F.struct("depth", "k1", "k2")).alias("l")).select("conv", "l.*")
    sizes = last.groupBy("depth", "k1", "k2").agg(F.count("*").alias("n"), F.min("conv").alias("only"))
    sizes = checkpointed(sizes)
    alone = sizes.where("n = 1").select("depth", "k1", "k2", F.sha2(F.col("only").cast("string"), 256).alias("ends_sha256"))
    many = sizes.where("n > 1").select("depth", "k1", "k2")
    ids = last.join(small_enough(many), ["depth", "k1", "k2"])
    ordered = ids.select("depth", "k1", "k2", "conv").repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "conv")
    ship(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        names = ["depth", "k1", "k2"]

        def told(key: tuple, state) -> pa.RecordBatch:
            columns = [pa.array([v], pa.int64()) for v in key]
            return pa.RecordBatch.from_arrays([*columns, pa.array([state.hexdigest()])], [*names, "ends_sha256"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
            convs = batch.column("conv").to_numpy()
            bounds = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, end in zip([0, *bounds.tolist()], [*bounds.tolist(), len(keys)]):
                here = tuple(keys[start].tolist())
                part = ",".join(map(str, convs[start:end].tolist()))
                if here == key:
                    state.update(b"," + part.encode())
                    continue
                if key is not None:
                    yield told(key, state)
                key, state = here, hashlib.sha256(part.encode())
        if key is not None:
            yield told(key, state)

    hashed = ordered.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")
    return nodes.select("conv", "depth", "k1", "k2").join(alone.unionByName(hashed), ["depth", "k1", "k2"]).select("conv", "depth", "ends_sha256")
