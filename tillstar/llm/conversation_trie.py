"""The trie of conversation prefixes, measured along its Euler tour.

Conversations that begin with the same turns share the nodes of those turns. A node is named by
(smallest member conversation, depth): each conversation names a run of nodes downwards, so two
integers are enough. The tour has an arc into and an arc out of every node; each arc knows its
successor from its node's first child, next sibling and parent. The tour is list-ranked
distributedly: nodes stand sorted by name, so long stretches of the tour lie within blocks of
neighbouring nodes; every block first contracts its stretches, and pointer jumping then ranks what
is left (each round a join on distinct keys, half the length to go). The sums carried along give the
prefix sums at arc positions, and a subtree's leaves and savings are the difference between the
position of its node's arc out and that of its arc in.

Prefixes are told apart by the exclusive or of 128-bit hashes of (place, SHA-256 of role and text) and by their depth.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.storage import materialise

CHUNK = 4096  # turns of a conversation whose hashes are run up together
BLOCK_NODES = 200_000  # nodes whose arcs are contracted at a time

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def in_blocks(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """The rows in global order of ``keys`` (nulls first), written in blocks (column ``block``) of a task each.
    A key that holds many rows is dealt over several blocks as far as the later keys tell its rows apart."""
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(placed.withColumn("block", F.spark_partition_id()), name)


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1, by turn, null first), digest (of role and text), size (UTF-8 bytes of the text) of every turn.

    Null roles and texts are empty. Turns of equal number stand in the order of their digest, so repeated rows are
    turns of their own. Rows without conversation id belong to none and are left out. Texts are hashed in the scan and not shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"))
    turns = in_blocks(turns, "turns", "conv_id", "turn", "digest")
    here = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "digest"))
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").select("conv_id", "block", "before")
    turns = turns.withColumn("here", here).join(blocks, ["conv_id", "block"], "left")
    return turns.select("conv_id", (F.col("here") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "digest", "size")


def rebuilt(turns: DataFrame, group: int = 5, keep: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one did: conversation c takes the first h = crc32(c) mod ``keep`` turns of
    c - c mod ``group`` and then its own after its first h. Returns their turns and (conv_id, length) of every conversation."""
    turns = materialise(turns, "ordered-turns")
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                       (F.crc32(F.col("conv_id").cast("string")) % keep).alias("h")).join(base, "base", "left")
    convs = convs.withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = materialise(convs.select("conv_id", "base", "h", "shared", "length"), "conversations")
    first = turns.filter(F.col("pos") < keep).withColumnRenamed("conv_id", "base").join(convs, "base").filter("pos <= shared")
    rest = turns.join(convs, "conv_id").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("shared"))
    columns = "conv_id", "pos", "digest", "size"
    return first.select(*columns).unionByName(rest.select(*columns)), convs.select("conv_id", "length")


def _with_prefixes(turns: DataFrame) -> DataFrame:
    """Adds a, b: the hash of all turns up to this one, and up, uq: that of the turns before it."""
    rows = turns.withColumn("x", F.xxhash64(F.lit(1), "pos", "digest")).withColumn("y", F.xxhash64(F.lit(2), "pos", "digest"))
    rows = rows.withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    within = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    chunks = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", F.bit_xor("x").over(earlier).alias("cx"), F.bit_xor("y").over(earlier).alias("cy")).filter("cx is not null")
    rows = rows.withColumn("a", F.bit_xor("x").over(within)).withColumn("b", F.bit_xor("y").over(within)).join(chunks, ["conv_id", "chunk"], "left")
    a = F.col("a").bitwiseXOR(F.coalesce("cx", F.lit(0)))
    b = F.col("b").bitwiseXOR(F.coalesce("cy", F.lit(0)))
    return rows.select("conv_id", "pos", "size", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("ua"), b.bitwiseXOR(F.col("y")).alias("ub"))


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids (ascending) that end at each node. Ids are joined within blocks of bounded size first;
    the hash itself then runs over a node's few long strings, one after the other, and holds one at a time."""
    key = "depth", "a", "b"
    ends = in_blocks(ends, "ends", *key, "conv_id")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    strings = ends.groupBy("block", *key).agg(joined.alias("ids")).repartition(*key).sortWithinPartitions(*key, "block")

    def run(batches):
        at, digest = None, None
        rows = [], [], [], []

        def closed():
            if at is not None:
                for column, value in zip(rows, (*at, digest.hexdigest())):
                    column.append(value)

        def taken():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                               names=[*key, "ends_sha256"])
            for c in rows:
                c.clear()
            return batch

        for batch in batches:
            for *node, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if node == at:
                    digest.update(b",")
                else:
                    closed()
                    at, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            yield taken()
        closed()
        yield taken()

    return strings.select(*key, "ids").mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _next_siblings(nodes: DataFrame) -> DataFrame:
    """conv_id, depth and the next greater conv_id among the children of the same parent, where there is one."""
    order = "parent_conv_id", "depth", "conv_id"
    rows = in_blocks(nodes.filter("depth > 0").select(*order), "siblings", *order)
    inside = F.lead(F.struct(*order)).over(Window.partitionBy("block").orderBy(*order))
    firsts = rows.groupBy("block").agg(F.min(F.struct(*order)).alias("first"))  # one row a block
    after = firsts.select("block", F.lead("first").over(Window.orderBy("block")).alias("after"))
    rows = rows.withColumn("next", inside).join(F.broadcast(after), "block").withColumn("next", F.coalesce("next", "after"))
    same = (F.col("next.parent_conv_id") == F.col("parent_conv_id")) & (F.col("next.depth") == F.col("depth"))
    return rows.filter(same).select("conv_id", "depth", F.col("next.conv_id").alias("next_sibling"))


ARC = "n", "leaves", "saved", "out_conv", "out_step"
ARCS = "conv_id long, depth long, " + ", ".join(f"{side}_{c} long" for side in ("in", "to") for c in ARC) + ", in_head boolean, to_head boolean"


def contract(conv, depth, parent, first_child, next_sibling, leaves, saved):
    """The stretches of the tour within a block of nodes sorted by (conv, depth); missing links are -1.

    Arc 2i enters node i, arc 2i + 1 leaves it; a step is 2 * depth, plus one on the way out. Returns, for each arc, the sums
    of (1, leaves, saved) from it to the end of its stretch, the arc after that end (conv, step; -1: the tour's end),
    and whether a stretch begins here.
    """
    n = len(conv)
    enters, leave = np.arange(0, 2 * n, 2), np.arange(1, 2 * n, 2)
    to_conv, to_step = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64)
    has = first_child >= 0
    to_conv[enters], to_step[enters] = np.where(has, first_child, conv), np.where(has, 2 * depth + 2, 2 * depth + 1)
    has = next_sibling >= 0
    to_conv[leave] = np.where(has, next_sibling, parent)
    to_step[leave] = np.where(has, 2 * depth, np.where(parent >= 0, 2 * depth - 1, -1))
    # The place of a target in the block: a conversation's nodes stand together, by depth.
    start = np.minimum(np.searchsorted(conv, to_conv), n - 1)
    place = start + (to_step >> 1) - depth[start]
    safe = np.clip(place, 0, n - 1)
    local = (to_step >= 0) & (place == safe) & (conv[safe] == to_conv) & (depth[safe] == to_step >> 1)
    end = 2 * n
    after = np.append(np.where(local, 2 * safe + (to_step & 1), end), end)
    head = np.ones(2 * n + 1, bool)
    head[after] = False
    sums = np.zeros((3, 2 * n + 1), np.int64)
    sums[0, :end], sums[1, enters], sums[2, enters] = 1, leaves, saved
    last = np.arange(2 * n + 1)
    while (after != end).any():
        sums += sums[:, after]
        last = np.where(after == end, last, last[after])
        after = after[after]
    last = last[:end]
    return sums[:, :end], to_conv[last], to_step[last], head[:end]


def _contracted(block_nodes: int):
    """Nodes sorted by (conv_id, depth) -> the arcs of both sides of every node, a block at a time."""
    def block(held):
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(7)]
        sums, out_conv, out_step, head = contract(*columns)
        arrays = [pa.array(columns[0]), pa.array(columns[1])]
        for side in (0, 1):
            none = out_step[side::2] < 0
            arrays += [pa.array(s[side::2]) for s in sums]
            arrays += [pa.array(out_conv[side::2], mask=none), pa.array(out_step[side::2], mask=none)]
        arrays += [pa.array(head[side::2]) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in ARCS.split(", ")])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_nodes):
                held.append(batch.slice(at, block_nodes))
                rows += held[-1].num_rows
                if rows >= block_nodes:
                    yield block(held)
                    held, rows = [], 0
        if rows:
            yield block(held)

    return run


def list_rank(stretches: DataFrame) -> DataFrame:
    """conv, step and the sums (n, leaves, saved) from here to the tour's end, by pointer jumping: in every round each stretch
    takes in the one it points to and points where that one did. Targets stay distinct, so no join key is hot."""
    columns = "conv", "step", *ARC
    stretches = materialise(stretches, "stretches")
    while stretches.filter("out_step is not null").limit(1).count():
        target = stretches.select(*[F.col(c).alias(f"t_{c}") for c in columns])
        going, done = stretches.filter("out_step is not null"), stretches.filter("out_step is null")
        jumped = going.join(target, (F.col("out_conv") == F.col("t_conv")) & (F.col("out_step") == F.col("t_step"))).select(
            "conv", "step", *[(F.col(c) + F.col(f"t_{c}")).alias(c) for c in ARC[:3]], *[F.col(f"t_{c}").alias(c) for c in ARC[3:]])
        stretches = materialise(done.unionByName(jumped), "stretches")
    return stretches


def _to_end(arcs: DataFrame, ranks: DataFrame, side: str) -> tuple[DataFrame, Column, Column]:
    """Joins the sums behind the stretch of one side's arc; the sums of leaves and saved from the arc to the tour's end."""
    behind = ranks.select(*[F.col(c).alias(f"{side}_behind_{c}") for c in ("conv", "step", "leaves", "saved")])
    arcs = arcs.join(behind, (F.col(f"{side}_out_conv") == F.col(f"{side}_behind_conv")) & (F.col(f"{side}_out_step") == F.col(f"{side}_behind_step")), "left")
    return arcs, *(F.col(f"{side}_{c}") + F.coalesce(f"{side}_behind_{c}", F.lit(0)) for c in ("leaves", "saved"))


def prefix_trie(turns: DataFrame, conversations: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """One row per distinct prefix of a conversation, the empty one included.

    ``turns``: conv_id, pos (1, 2, ... without gaps), digest, size; ``conversations``: conv_id, length, one row each, also
    for those without turns. Conversation ids are not negative. Returns conv_id (smallest member), depth, parent_conv_id
    (null at the root), n_convs, n_children, n_leaves, saved_tokens ((n_convs - 1) * size over the subtree) and ends_sha256.
    An empty table of conversations has no node. A prefix shared by any number of conversations, a parent of any number of
    children and a conversation of any length are dealt over tasks.
    """
    rows = materialise(_with_prefixes(turns), "prefixes")
    total = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = total.select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id", "n_convs",
                        F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("ua"), F.lit(None).cast("long").alias("ub"))
    nodes = rows.groupBy(F.col("pos").alias("depth"), "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), F.min("ua").alias("ua"), F.min("ub").alias("ub"))
    nodes = materialise(nodes.unionByName(root), "nodes")
    top = total.select("conv_id").first()  # the root's name
    parent = nodes.filter("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.filter("depth > 1").join(parent, ["depth", "ua", "ub"]).select(*nodes.columns, "parent_conv_id")
    high = nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(top and top["conv_id"]).cast("long"))
    high = high.unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends = rows.join(conversations, "conv_id").filter("pos = length").select(F.col("pos").alias("depth"), "a", "b", "conv_id")
    none = F.lit(0).cast("long")
    ends = ends.unionByName(conversations.filter("length = 0").select(none.alias("depth"), none.alias("a"), none.alias("b"), "conv_id"))
    nodes = deep.unionByName(high).join(_digests(ends), ["depth", "a", "b"], "left")
    nodes = materialise(nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "size", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")), "nodes")

    children = nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").join(_next_siblings(nodes), ["conv_id", "depth"], "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = materialise(nodes, "linked-nodes")

    missing = F.lit(-1).cast("long")
    links = nodes.select("conv_id", "depth", *[F.coalesce(c, missing).alias(c) for c in ("parent_conv_id", "first_child", "next_sibling")],
                         (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    arcs = materialise(links.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").mapInArrow(_contracted(block_nodes), ARCS), "arcs")
    heads = [arcs.filter(f"{side}_head").select(F.col("conv_id").alias("conv"), (2 * F.col("depth") + out).alias("step"), *[F.col(f"{side}_{c}").alias(c) for c in ARC])
             for side, out in (("in", 0), ("to", 1))]
    ranks = list_rank(heads[0].unionByName(heads[1]))
    measured, leaves_in, saved_in = _to_end(arcs, ranks, "in")
    measured, leaves_to, saved_to = _to_end(measured, ranks, "to")
    measured = measured.select("conv_id", "depth", (leaves_in - leaves_to).alias("n_leaves"), (saved_in - saved_to).alias("saved_tokens"))
    return nodes.join(measured, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
