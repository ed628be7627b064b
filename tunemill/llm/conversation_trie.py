"""The trie of all conversations' turns, with sums over subtrees; shards share only a skeleton.

1. Rebuilding. Turns become digests (16 bytes of SHA-256 of role and text) and word counts; texts don't travel. The
   conversations that take over turns from one another lie in one block of `FAMILY` ids and are put together there. A
   conversation is then a path: its digests one after another. Byte order of paths is the order of a trie.
2. Shards. Paths are dealt out by range of (path, conv_id) and sorted; conv_id keeps copies of one conversation
   from being one indivisible key. A node's members lie side by side, so it reaches over a shard's edge only if the
   paths on both sides of the edge start with it.
3. Skeleton. The paths at the edges are the splitters. Their trie is broadcast as a trie in sorted order is written down: by
   the number of turns that each splitter has in common with the path before it, 16 bytes a shard. A node is of
   the skeleton if it is no deeper than that number at the edge it touches.
4. Local nodes. A task goes once through its shard with a stack of the path it is on. It finishes every other node
   there, and gives a partial sum for each node of the skeleton that it meets.
5. Reduction. Partial sums are aggregated by node. One pass over the skeleton (as many rows at most as the splitters have
   turns in common), in the order of the trie, adds what lies below to what lies above. Lists of
   conversations that end at a node of the skeleton are pieces of bounded size, hashed one after another.

A null role or text is empty. Turns are in order of `turn`, a null first; of turns with one number, the one with the smaller
digest comes first. Rows that repeat a turn are turns of their own. Rows with a null conv_id belong to no
conversation. A very long text is one digest; a conversation is worked on as one list of digests, so its 24 bytes a turn have to fit
into a task. An empty table has no nodes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tunemill.llm.common import SPACE, discard, stored

FAMILY, HEADS = 20, 4
DIGEST = 16
#: Conversations in one piece of a list of those that end at a node of the skeleton.
PIECE = 50_000
#: A node's columns, and what a shard gives beside them: `key` and `parent` name nodes of the skeleton, `ends` is a piece of a list.
ROW = pa.schema(
    [
        *[(c, pa.int64()) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "row")],
        *[(c, pa.int32()) for c in ("depth", "words", "shard")],
        *[(c, pa.string()) for c in ("ends_sha256", "kind", "ends")],
        *[(c, pa.binary()) for c in ("key", "parent")],
    ]
)
BATCH = 8192


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, digest, words of each turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.substring(F.unhex(F.sha2(said, 256)), 1, DIGEST).alias("digest"),
        F.size(F.array_remove(F.split(text, SPACE), "")).alias("words"),
    )


def own_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest, words) as they stand in the table."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    kept = F.transform(listed, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return turn_digests(turns).groupBy("conv_id").agg(kept.alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Like `own_turns`; the first crc32(conv_id) % HEADS turns are those of the family's first conversation."""
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    family = Window.partitionBy("first")
    head = F.max(F.when(F.col("conv_id") == F.col("first"), F.slice("turns", 1, HEADS - 1))).over(family)
    nothing = F.slice("turns", 1, 0)
    rows = own_turns(turns).withColumn("first", first).withColumn("head", F.coalesce(head, nothing))
    start, rest = F.slice("head", F.lit(1), taken), F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
    return rows.select("conv_id", F.concat(start, rest).alias("turns"))


def sorted_shards(paths: DataFrame) -> DataFrame:
    """conv_id, path, words in order of (path, conv_id), cut into shards. A stored table."""
    path = F.unhex(F.array_join(F.transform("turns.digest", lambda d: F.hex(d)), ""))
    rows = paths.select("conv_id", path.alias("path"), F.col("turns.words").alias("words"))
    # Written before it is dealt out: sampling for the ranges reads it once more.
    whole = stored(rows, "paths")
    cut = whole.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    shards = stored(cut.withColumn("shard", F.spark_partition_id()), "shards")
    discard(whole)
    return shards


def common_turns(a: bytes, b: bytes) -> int:
    """The number of turns that two paths have in common from the start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def splitter_trie(shards: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard that has rows, the turns in common over its left and its right edge; -1 where there is no edge.

    A row per shard comes to the driver, without any path.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, at = batch["shard"].to_numpy(), np.arange(batch.num_rows)
            edge = np.diff(number) != 0
            for places in (at[np.append(True, edge)[: len(at)]], at[np.append(edge, True)[: len(at)]]):
                yield batch.select(["shard", "path"]).take(pa.array(places))

    edges = shards.select("shard", "path").mapInArrow(ends, "shard int, path binary")
    edges = edges.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # A row per shard passes through this window.
    edges = edges.withColumn("before", F.lag("last").over(Window.orderBy("shard"))).select("shard", "before", "first")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch["before"].to_pylist(), batch["first"].to_pylist())
            shared = [-1 if before is None else common_turns(before, first) for before, first in pairs]
            yield pa.record_batch([batch["shard"], pa.array(shared, pa.int32())], ["shard", "shared"])

    left = sorted((r["shard"], r["shared"]) for r in edges.mapInArrow(compare, "shard int, shared int").collect())
    right = [shared for _, shared in left[1:]] + [-1]
    return {number: (shared, after) for (number, shared), after in zip(left, right)}


class Open:
    """A node on the path that a task is on: what is known of it so far."""

    __slots__ = ("conv_id", "ends", "n_children", "n_convs", "n_leaves", "pending", "row", "saved", "words")

    def __init__(self, words: int, row: int):
        self.words, self.row = words, row
        self.conv_id = self.ends = None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.pending = []

    def members(self, n: int, smallest: int) -> None:
        self.n_convs += n
        self.conv_id = smallest if self.conv_id is None else min(self.conv_id, smallest)


class Shard:
    """One pass over a shard's rows; `rows` fills with finished nodes and partial sums."""

    def __init__(self, number: int, left: int, right: int):
        self.number, self.left, self.right = number, left, right
        self.path, self.stack, self.rows, self.count = b"", [], [], 0

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        if self.stack:
            keep = common_turns(self.path, path)
            while len(self.stack) > keep + 1:
                self.close(last=False)
        else:
            self.stack.append(Open(0, self.count))
        self.path = path
        for depth in range(len(self.stack), len(words) + 1):
            self.stack.append(Open(words[depth - 1], self.count))
        end = self.stack[-1]
        if end.ends is None:
            end.ends = array("q")
        end.ends.append(conv_id)
        end.members(1, conv_id)
        self.count += 1

    def finish(self) -> None:
        while self.stack:
            self.close(last=True)

    def cut(self, node: Open, depth: int, last: bool) -> bool:
        """Whether the node is of the skeleton; `last` tells that it holds the shard's last row."""
        return (node.row == 0 and depth <= self.left) or (last and depth <= self.right)

    def key(self, depth: int) -> bytes:
        return hashlib.sha256(depth.to_bytes(8, "big") + self.path[: depth * DIGEST]).digest()[:DIGEST]

    def put(self, kind: str, found: dict, **more) -> None:
        self.rows.append({"kind": kind, "shard": self.number, **found, **more})

    def close(self, last: bool) -> None:
        """Takes the deepest node off the stack."""
        depth, node = len(self.stack) - 1, self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if above:
            above.members(node.n_convs, node.conv_id)
        found = {"conv_id": node.conv_id, "depth": depth, "n_convs": node.n_convs, "n_children": node.n_children}
        if self.cut(node, depth, last):
            key, parent = self.key(depth), self.key(depth - 1) if depth else None
            for start in range(0, len(node.ends or ()), PIECE):
                self.put("ends", {"key": key, "row": start, "ends": ",".join(map(str, node.ends[start : start + PIECE]))})
            for child in node.pending:
                self.put("below", child, parent=key)
            sums = {"n_leaves": node.n_leaves, "saved_tokens": node.saved}
            self.put("part", found, **sums, key=key, parent=parent, words=node.words, row=node.row)
            return
        found["n_leaves"] = node.n_leaves + (not node.n_children)
        found["saved_tokens"] = node.saved + (node.n_convs - 1) * node.words
        found["ends_sha256"] = hashlib.sha256(",".join(map(str, node.ends or ())).encode()).hexdigest()
        for child in node.pending:
            self.put("node", child, parent_conv_id=node.conv_id)
        if above is None:
            self.put("node", found)
            return
        above.n_children += 1
        above.n_leaves += found["n_leaves"]
        above.saved += found["saved_tokens"]
        if self.cut(above, depth - 1, last=False):
            self.put("below", found, parent=self.key(depth - 1))
        else:
            # The smallest member of the node above is not known yet.
            above.pending.append(found)


def shard_nodes(shards: DataFrame) -> DataFrame:
    """Finished nodes (`node`, or `below` where the node above is of the skeleton), partial sums (`part`) and lists (`ends`)."""
    trie = shards.sparkSession.sparkContext.broadcast(splitter_trie(shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for number, conv_id, path, words in zip(*(batch[c].to_pylist() for c in ("shard", "conv_id", "path", "words"))):
                if shard is None or shard.number != number:
                    before, shard = shard, Shard(number, *trie.value[number])
                    if before:
                        before.finish()
                        shard.rows = before.rows
                shard.add(conv_id, path, words)
                if len(shard.rows) >= BATCH:
                    yield pa.RecordBatch.from_pylist(shard.rows, ROW)
                    shard.rows = []
        if shard:
            shard.finish()
            for start in range(0, len(shard.rows), BATCH):
                yield pa.RecordBatch.from_pylist(shard.rows[start : start + BATCH], ROW)

    whole = shards.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    return whole.select("shard", "conv_id", "path", "words").mapInArrow(run, from_arrow_schema(ROW))


def skeleton_nodes(rows: DataFrame) -> DataFrame:
    """key and the columns of a node for each node of the skeleton."""
    parts = rows.where("kind = 'part'").groupBy("key").agg(
        F.min(F.struct("shard", "row")).alias("start"),
        F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("depth", "words")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of the trie; each node's sums go to the node above once all below it have been seen."""
        path = []

        def close() -> dict:
            node = path.pop()
            node["n_leaves"] += not node["n_children"]
            node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("words")
            if path:
                above = path[-1]
                node["parent_conv_id"] = above["conv_id"]
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
            return node

        for batch in batches:
            done = []
            for node in batch.to_pylist():
                while len(path) > node["depth"]:
                    done.append(close())
                path.append(node)
            yield _sums(done)
        yield _sums([close() for _ in range(len(path))])

    columns = ["key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    one = parts.repartition(1).sortWithinPartitions("start", "depth").select(*columns, "words")
    sums = one.mapInArrow(add_up, "key binary, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return sums.join(skeleton_ends(rows), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))


def _sums(nodes: list[dict]) -> pa.RecordBatch:
    kinds = {"key": pa.binary(), "depth": pa.int32()}
    names = ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return pa.record_batch([pa.array([n.get(c) for n in nodes], kinds.get(c, pa.int64())) for c in names], names)


def skeleton_ends(rows: DataFrame) -> DataFrame:
    """key, ends_sha256: pieces of a node's list go through one hash, as a hash has no parts; one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hasher = None
        for batch in batches:
            done = []
            for at, ends in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
                if at != key:
                    if key is not None:
                        done.append((key, hasher.hexdigest()))
                    key, hasher = at, hashlib.sha256(ends.encode())
                else:
                    hasher.update(f",{ends}".encode())
            yield _hashes(done)
        yield _hashes([(key, hasher.hexdigest())] if key is not None else [])

    pieces = rows.where("kind = 'ends'").repartition("key").sortWithinPartitions("key", "shard", "row")
    return pieces.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def _hashes(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])


def conversation_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    Without `rebuild` conversations are taken as they stand.
    """
    shards = sorted_shards(rebuilt(turns) if rebuild else own_turns(turns))
    rows = stored(shard_nodes(shards), "nodes")
    skeleton = stored(skeleton_nodes(rows), "skeleton")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = skeleton.select(F.col("key").alias("parent"), F.col("conv_id").alias("found"))
    below = rows.where("kind = 'below'").drop("parent_conv_id").join(above, "parent").withColumnRenamed("found", "parent_conv_id")
    nodes = rows.where("kind = 'node'").select(*names).union(below.select(*names)).union(skeleton.select(*names))
    discard(shards)
    return nodes.withColumn("depth", F.col("depth").cast("long"))
