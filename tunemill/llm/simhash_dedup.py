"""Near duplicates by SimHash, found through Golay-code keys.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 values (seed 42) of a
text's 3-word shingles. Fingerprints that differ in two bits at most are linked.

Search: the fingerprint is cut into three segments of 22, 21 and 21 bits. Two errors over three
segments leave, for one of the three (segment, next segment) pairs, the first without an error and
the next with one at most (two errors in one segment: the pair after it or before it). A key is
the first segment as it is and a code word near the next one (see golay), which gives up to 18 keys.

Links: members of a key with `PAIRED` fingerprints or fewer are compared pair by pair. In larger
ones every fingerprint is listed under itself and its 64 one-bit neighbours instead: two fingerprints
are at most two bits apart exactly if they share such a centre, and all that share one are
linked to its smallest member. So a large group of near copies costs 65 rows a fingerprint, loses no
component, and is never paired. Equal fingerprints count once throughout.

Null texts and texts without words have the fingerprint zero and are linked like any other. A row
with a null id has a fingerprint and takes the component of its fingerprint, but links nothing.
Rows that repeat an id are one document: they link to each other where the ids' fingerprints do.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tunemill.llm.common import encoded, per_row, space_words, stored
from tunemill.llm.components import connected_components
from tunemill.llm.golay import near_code_words

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
#: Key groups up to this many fingerprints are compared pair by pair; larger ones go by centres.
PAIRED = 64
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HASHES_AT_A_TIME = 1 << 16


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle, repeats included; a text of fewer words is one shingle, one without words has none."""
    words = space_words(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = min(size, len(words)) - 1
    starts, ends = starts[: len(words) - last].tolist(), ends[last:].tolist()
    return np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; zero for none."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_A_TIME):
        some = hashes[at : at + HASHES_AT_A_TIME].astype("<u8")
        bits = np.unpackbits(some.view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes) -> int:
    return majority(shingle_hashes(text))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(encoded(text)) for text in batch["text"].to_pylist()], np.uint64)
        return pa.record_batch([batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return per_row(docs.select("doc_id", "text"), "doc_id long, fp long", rows)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys; fingerprints at most two bits apart have a key in common."""
    fps = fps.view(np.uint64)
    parts = [(fps >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    owners, keys = [], []
    for kind in range(3):
        exact, fuzzy = parts[kind], parts[(kind + 1) % 3]
        near = near_code_words(fuzzy).astype(np.uint64)
        key = np.uint64(kind << 34) | exact[:, None] << np.uint64(12) | near
        fresh = np.ones(key.shape, bool)
        fresh[:, 1:] = key[:, 1:] != key[:, :1]
        owners.append(np.nonzero(fresh)[0])
        keys.append(key[fresh])
    return np.concatenate(owners), np.concatenate(keys).astype(np.int64)


def keyed(nodes: DataFrame) -> DataFrame:
    """key, fp, node: `nodes` under each of its Golay keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, keys = golay_keys(batch["fp"].to_numpy())
            owners = pa.array(owners)
            yield pa.record_batch([pa.array(keys), batch["fp"].take(owners), batch["node"].take(owners)], ["key", "fp", "node"])

    return nodes.mapInArrow(run, "key long, fp long, node long")


def links_between(nodes: DataFrame) -> DataFrame:
    """a, b: enough links between the nodes (fp, node; fps distinct) for all their components."""
    keys = keyed(nodes)
    sized = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = keys.join(sized, "key")
    # Grouped under another name of the key, so that the join before may still split a large one.
    near = F.expr(
        f"explode(filter(members, m -> m.node < one.node AND bit_count(m.fp ^ one.fp) <= {DISTANCE}))"
    )
    paired = (
        members.where(F.col("n") <= PAIRED)
        .groupBy(F.xxhash64("key").alias("bucket"))
        .agg(F.collect_list(F.struct("fp", "node")).alias("members"))
        .select("members", F.explode("members").alias("one"))
        .select("one", near.alias("other"))
        .select(F.col("one.node").alias("a"), F.col("other.node").alias("b"))
    )
    flips = F.array(*[F.lit(0 if bit < 0 else (1 << bit) - (1 << 64 if bit == 63 else 0)) for bit in range(-1, 64)])
    centred = (
        members.where(F.col("n") > PAIRED)
        .select("fp", "node")
        .distinct()
        .select("node", "fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
        .agg(F.min("node").alias("b"), F.collect_list("node").alias("nodes"))
        .where(F.size("nodes") > 1)
        .select(F.explode("nodes").alias("a"), "b")
    )
    return paired.union(centred).where("a <> b").distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) for each row."""
    found = stored(fingerprints(docs), "fingerprints")
    named = found.where("doc_id IS NOT NULL")
    nodes = stored(named.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    repeats = (
        named.groupBy("doc_id")
        .agg(F.min("fp").alias("fp"), F.max("fp").alias("last"))
        .where("fp <> last")
    )
    if repeats.isEmpty():
        links = links_between(nodes)
    else:
        links = links_between(nodes).union(_same_id(named, nodes))
    components = connected_components(links)
    classes = nodes.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return found.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _same_id(named: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the fingerprints of one id, where an id is repeated with different texts."""
    ends = named.distinct().join(nodes, "fp").select("doc_id", "node")
    return ends.join(ends.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, but one document of each component by SimHash and 5-word Jaccard (near_dedup).

    The document with the smallest id stays. A row with a null id can't be named and stays.
    """
    from tunemill.llm.near_dedup import duplicates

    return docs.join(duplicates(docs), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
