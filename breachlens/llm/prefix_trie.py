"""Prefix trie of conversations, from adaptive radix trees over turn ids.

A turn's id is ``ID_BYTES`` bytes of the SHA-256 of its role and text, so a conversation is a key of fixed-width
big-endian ids. The keys are range-partitioned and sorted, with the conversation's id as the last
criterion, and each task builds radix trees over consecutive keys (shards of bounded size). A compressed
path or a branch may end anywhere in an id; trie nodes are emitted at byte depths that are whole turns.

All conversations below a trie node are neighbours in the order. A node that lies on neither the first
nor the last key's path of its shard is therefore complete there, with all sums over its subtree. What is
on those two paths goes out as partial rows, some two per shard and depth, which are merged by the digest
of their prefix: counts are added, and sums over subtrees are running sums along the paths. So a first turn
or a whole conversation that a third of all rows share is just spread over many shards. The ids of the
conversations that end in such a node are hashed in order by one streaming task, as SHA-256 has no other way.

Conversations: turns ordered by turn (null first), equal turn numbers by turn id; repeated rows are turns
of their own; null role or text is empty; turns without conversation id belong to none and are left out.
A conversation is one row of ``ID_BYTES`` + 8 bytes per turn from the grouping on, however long its texts are.
An empty table has no node, not even a root. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breachlens.llm.common import remove_folder
from breachlens.llm.radix_tree import Node, RadixTree
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

ID_BYTES = 16
#: Conversations whose first turns may be replaced belong to blocks of so many ids, which start at a multiple.
BLOCK = 5
#: A conversation takes fewer turns than this from the first one of its block.
MAX_SHARED = 9
#: Memory of a tree (about) at which its shard is closed.
SHARD_BYTES = 32 << 20
#: Rows of a task that go out together.
ROWS = 8192

_FIRST, _LAST = 1, 2
_SHARD = pa.schema(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
        ("shard", pa.int64()), ("side", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("size", pa.int64()),
        ("ends", pa.binary()),
    ]
)
_SHARD_DDL = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, shard bigint, side int, node binary, parent binary, size bigint, ends binary"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- conversations --------------------------------------------------------------
def turn_id(role: Column, text: Column) -> Column:
    """Hexadecimal id; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES)


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): the ids of each rebuilt conversation's turns in a row, and the bytes of their texts.

    One shuffle, by the block of the conversation, serves the grouping by conversation and the look-up
    of the block's first conversation.
    """
    conv = F.col("conv_id").cast("bigint")
    block = conv - F.pmod(conv, F.lit(BLOCK))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    turn = F.struct(F.col("turn").isNotNull(), "turn", turn_id(F.col("role"), F.col("text")).alias("id"), size.alias("size"))
    slim = turns.where(F.col("conv_id").isNotNull()).select(block.alias("block"), conv.alias("conv_id"), turn.alias("t"))
    own = slim.repartition("block").groupBy("block", "conv_id").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("own")
    )
    head = F.max(F.when(F.col("conv_id") == F.col("block"), F.slice("own", 1, MAX_SHARED - 1))).over(Window.partitionBy("block"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MAX_SHARED)).cast("int")
    taken = F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("shared")))
    rest = F.slice("own", F.col("shared") + 1, F.greatest(F.size("own"), F.lit(1)))
    whole = own.select("conv_id", "own", head.alias("head"), shared.alias("shared")).select("conv_id", F.concat(taken, rest).alias("t"))
    return whole.select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["id"]), "")).alias("key"),
        F.transform("t", lambda t: t["size"]).alias("sizes"),
    )


# --- shards ---------------------------------------------------------------------
class _Run:
    """Conversations with one key: their ids, ascending, and the sizes of the turns."""

    __slots__ = ("convs", "sizes")

    def __init__(self, sizes: np.ndarray):
        self.convs, self.sizes = array("q"), sizes

    def text(self) -> bytes:
        return ",".join(map(str, self.convs)).encode()


class _Note:
    """What is known of a tree node: members, smallest member, sizes of a member's turns, whose path it is on, and
    the trie nodes just below the last whole turn with their sums."""

    __slots__ = ("start", "end", "n", "least", "sizes", "sides", "up", "above")


def _aligned(start: int, end: int) -> range:
    """Byte depths of whole turns after ``start`` up to ``end``, deepest first."""
    return range(end // ID_BYTES * ID_BYTES, start, -ID_BYTES)


def _digests(key: bytes) -> list[bytes]:
    """Digest of each prefix of whole turns."""
    running = hashlib.sha256()
    out = [running.digest()]
    for at in range(0, len(key), ID_BYTES):
        running.update(key[at : at + ID_BYTES])
        out.append(running.digest())
    return out


def _measure(node: Node) -> None:
    """Fill in the note of a node whose children have theirs."""
    note, run = node.note, node.value
    children = [child.note for child in node.ordered()]
    note.n = sum(c.n for c in children) + (len(run.convs) if run else 0)
    note.least = min([c.least for c in children] + ([run.convs[0]] if run else []))
    note.sizes = run.sizes if run else children[0].sizes


def shard_rows(tree: RadixTree, first: bytes, last: bytes, shard: int) -> Iterator[tuple]:
    """The rows of one shard: complete nodes, nodes on the paths to its first and last key, and ends of those.

    Complete rows below a path carry ``shard`` and ``side`` of their parent instead of its conversation.
    """
    order = []
    for node, start, end in tree.preorder():
        node.note = note = _Note()
        note.start, note.end, note.sides = start, end, 0
        order.append(node)
    for side, key in ((_FIRST, first), (_LAST, last)):
        for node in tree.path_to(key):
            node.note.sides |= side
    digests = {_FIRST: _digests(first), _LAST: _digests(last)}
    pending: list[tuple[Node, int, int, int, int]] = []  # node, depth, children, leaves, saved
    for node in reversed(order):
        _measure(node)
        note = node.note
        tops, leaves, saved = map(sum, zip((0, 0, 0), *(child.note.up for child in node.ordered())))
        for at in _aligned(note.start, note.end):
            depth = at // ID_BYTES
            size = int(note.sizes[depth - 1]) if depth else 0
            if note.sides:
                counted = (note.n, tops, leaves, saved)
                for side in (_FIRST, _LAST):
                    if note.sides & side:
                        of = digests[side]
                        yield (
                            note.least, depth, None, *counted, None, shard, side, of[depth],
                            of[depth - 1] if depth else None, size, None,
                        )
                        counted = (0, 0, 0, 0)  # once per shard
                tops = leaves = saved = 0
            else:
                leaves, saved = leaves if tops else 1, saved + (note.n - 1) * size
                pending.append((node, depth, tops, leaves, saved))
                tops = 1
        note.up = (tops, leaves, saved)
        if node.value and note.sides:
            side = _FIRST if note.sides & _FIRST else _LAST
            yield (*[None] * 8, shard, None, digests[side][note.end // ID_BYTES], None, None, node.value.text())
    tree.root.note.above = None
    for node in order:  # parents first: (side, smallest member) of the nearest trie node above
        note = node.note
        whole = len(_aligned(note.start, note.end)) > 0
        below = (note.sides & -note.sides or None, note.least) if whole else note.above
        for child in node.ordered():
            child.note.above = below
    for node, depth, n_children, n_leaves, saved in pending:
        note = node.note
        side, least = (None, note.least) if (depth - 1) * ID_BYTES > note.start else note.above
        run = node.value if depth * ID_BYTES == note.end else None
        ends = hashlib.sha256(run.text()).hexdigest() if run else NO_ENDS
        yield (
            note.least, depth, None if side else least, note.n, n_children, n_leaves, saved, ends,
            shard if side else None, side, None, None, None, None,
        )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SHARD)], schema=_SHARD)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees over consecutive keys of a sorted partition, closed at ``SHARD_BYTES``."""
    shard, tree, run, held, first, last = TaskContext.get().partitionId() << 32, None, None, 0, b"", None

    def out() -> Iterator[pa.RecordBatch]:
        rows = []
        for row in shard_rows(tree, first, last, shard):
            rows.append(row)
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    for batch in batches:
        sizes, edges = batch.column(2).flatten().to_numpy(), batch.column(2).offsets.to_numpy()
        edges = edges - edges[0]
        for i, (conv, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
            key = key.as_py()
            if tree is not None and held > SHARD_BYTES:
                yield from out()
                shard, tree, held, last = shard + 1, None, 0, None
            if tree is None:
                tree, first = RadixTree(), key
            if key != last:
                run = _Run(sizes[edges[i] : edges[i + 1]].copy())
                tree.insert(key, run)
                last = key
                held += 1000 + 3 * len(key)
            run.convs.append(conv)
            held += 32
    if tree is not None:
        yield from out()


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the joined pieces of each node, which come one after another."""
    names, node, running = ["node", "ends_sha256"], None, None
    for batch in batches:
        done = []
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = key, hashlib.sha256()
            else:
                running.update(b",")
            running.update(piece)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], names)


# --- merging --------------------------------------------------------------------
def _merged_paths(partial: DataFrame, path: str) -> DataFrame:
    """(shard, side, depth, node, ...): every node on a shard's first or last path, with its whole counts and its
    shard's share of the sums over its subtree."""
    merged = partial.groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"), F.sum("saved_tokens").alias("inner_saved"),
        F.max("size").alias("size"), F.min(F.struct("shard", "side")).alias("owner"),
    )
    merged = write_layer(merged, f"{path}-merged")
    on_paths = merged.groupBy("parent").agg(F.count(F.lit(1)).alias("more")).withColumnRenamed("parent", "node")
    n_children = F.col("inner_children") + F.coalesce("more", F.lit(0))
    whole = merged.join(on_paths, "node", "left").select(
        "node", "conv_id", "n_convs", n_children.alias("n_children"), "owner",
        (F.col("inner_leaves") + (n_children == 0).cast("bigint")).alias("own_leaves"),
        (F.col("inner_saved") + (F.col("n_convs") - 1) * F.col("size")).alias("own_saved"),
    )
    rows = partial.select("shard", "side", "depth", "node").join(whole, "node")
    # a node's own share counts on one of the paths that it is on
    mine = F.struct("shard", "side") == F.col("owner")
    upward = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc())
    below = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return write_layer(
        rows.select(
            "shard", "side", "depth", "node", "conv_id", "n_convs", "n_children",
            F.lead("conv_id").over(upward).alias("parent_conv_id"),
            F.sum(F.when(mine, F.col("own_leaves")).otherwise(0)).over(below).alias("n_leaves"),
            F.sum(F.when(mine, F.col("own_saved")).otherwise(0)).over(below).alias("saved_tokens"),
        ),
        path,
    )


def prefix_trie(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """One row per trie node; columns as in ``COLUMNS``. ``turns`` has conv_id, turn, role and text."""
    folder = new_folder(spark, "prefix-trie")
    keys = write_layer(rebuilt_conversations(turns), f"{folder}/keys")
    ordered = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = write_layer(ordered.mapInArrow(_shards, _SHARD_DDL), f"{folder}/shards")
    remove_folder(spark, f"{folder}/keys")
    paths = _merged_paths(rows.where("node IS NOT NULL AND depth IS NOT NULL"), f"{folder}/paths")
    pieces = rows.where("ends IS NOT NULL").select("node", "ends", "shard").repartition("node").sortWithinPartitions("node", "shard")
    ends = pieces.select("node", "ends").mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    on_paths = (
        paths.groupBy("node")
        .agg(
            *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")],
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        )
        .join(ends, "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    )
    inner = rows.where("node IS NULL")
    above = paths.select("shard", "side", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    below = inner.where("shard IS NOT NULL").join(above, ["shard", "side", "depth"]).withColumn("parent_conv_id", F.col("above"))
    return inner.where("shard IS NULL").select(*COLUMNS).union(below.select(*COLUMNS)).union(on_paths.select(*COLUMNS))
