"""Benchmark decontamination by a positional inverted index.

The index holds every word of every document, in blocks of some megabytes of text: one row per block
with its distinct words in order, and for each word the list of places where it stands. A place is
a number within the block; a gap after each document keeps phrases from running across. The index
is written once and may be searched for any number of benchmarks.

Search: item texts are cut into windows of consecutive words. Windows are looked up in each block,
the words with the shortest lists first: list, less the word's offset in the window, intersected with
the next one, until none is left or all words are in. A window with a word that the block lacks ends at
once. What remains are exact phrase matches. With `slop`, windows whose words all stand within that
many extra places around the rarest word, in any order, are found as proximity matches.

The benchmark is searched for in parts of up to `part_words` words, each broadcast to all blocks, so a
benchmark of any size is searched for as a whole, and the size of what is broadcast is fixed.

A null text has no words, neither has one of punctuation only: such documents have no hits, such
items no windows. A null id is kept as it is. Rows that repeat an id are told apart. Repeated items
count once by id; a null item id has no windows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import alnum_words, encoded, in_slices, stored

WINDOW = 10
PART_WORDS = 50_000
BLOCK_BYTES = 4_000_000
INDEX = "doc_ids array<bigint>, sizes array<int>, words binary, lengths binary, places binary"
MATCHES = (
    "block long, row int, doc_id long, n_words long, spans array<struct<start: int, end: int>>, "
    "items array<string>, near array<string>"
)


class Part(NamedTuple):
    """Some of the benchmark: distinct words, windows as rows of word numbers (-1: beyond its end), owners."""

    words: list[bytes]
    windows: np.ndarray
    items: list


def build_index(docs: DataFrame) -> DataFrame:
    """One row per block of documents; null texts are in it without words. Written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, limit=BLOCK_BYTES):
            words = [alnum_words(encoded(text)) for text in part["text"].to_pylist()]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = pa.array([word for one in words for word in one], pa.large_binary()).dictionary_encode()
            numbers = flat.indices.to_numpy()
            # One place is left free after each document.
            places = np.arange(len(numbers)) + np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(numbers, kind="stable")
            lengths = np.bincount(numbers, minlength=len(flat.dictionary))
            yield pa.record_batch(
                [
                    pa.array([part["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
                    # Words hold no blank, so blanks can stand between them.
                    pa.array([b" ".join(flat.dictionary.to_pylist())], pa.binary()),
                    pa.array([lengths.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([places[order].astype(np.int32).tobytes()], pa.binary()),
                ],
                ["doc_ids", "sizes", "words", "lengths", "places"],
            )

    blocks = docs.select("doc_id", "text").mapInArrow(run, INDEX)
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), "index")


def item_windows(text: bytes) -> list[tuple[bytes, ...]]:
    words = alnum_words(text)
    if not words:
        return []
    return [tuple(words[at : at + WINDOW]) for at in range(max(len(words) - WINDOW, 0) + 1)]


def parts_of(items: list[tuple[str, bytes]]) -> Part:
    owners: dict[tuple[bytes, ...], set] = {}
    for item, text in items:
        for window in item_windows(text):
            owners.setdefault(window, set()).add(item)
    number: dict[bytes, int] = {}
    windows = np.full((len(owners), WINDOW), -1, np.int64)
    for row, window in enumerate(owners):
        windows[row, : len(window)] = [number.setdefault(word, len(number)) for word in window]
    return Part(list(number), windows, [sorted(found) for found in owners.values()])


def benchmark_parts(benchmark: DataFrame, part_words: int = PART_WORDS) -> Iterator[Part]:
    """The benchmark in parts of about `part_words` words; streams through the driver, one part at a time."""
    some: list[tuple[str, bytes]] = []
    total = 0
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string"), "text")
    for item, text in rows.toLocalIterator():
        size = len(alnum_words(encoded(text)))
        if some and total + size > part_words:
            yield parts_of(some)
            some, total = [], 0
        some.append((item, encoded(text)))
        total += size
    if some:
        yield parts_of(some)


class Block:
    """One row of the index, opened for the words of a part."""

    def __init__(self, row: dict, part: Part):
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.places = np.frombuffer(row["places"], np.int32)
        words = pa.array(row["words"].split(b" ") if row["words"] else [], pa.large_binary())
        at = pc.index_in(pa.array(part.words, pa.large_binary()), words).fill_null(-1).to_numpy(zero_copy_only=False)
        self.there = np.append(at, len(lengths))
        ends = np.append(np.cumsum(lengths), 0)
        self.ends = ends
        # Length of a part's word's list: 0 where the block lacks it.
        self.length = np.where(at >= 0, np.append(lengths, 0)[at], 0)

    def of(self, word: int) -> np.ndarray:
        at = self.there[word]
        end = self.ends[at]
        return self.places[end - self.length[word] : end]

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def phrases(self, window: np.ndarray) -> np.ndarray:
        """Places where the window's words stand one after the other."""
        offsets = np.argsort(self.length[window], kind="stable")
        found = self.of(window[offsets[0]]) - offsets[0]
        for offset in offsets[1:]:
            if not len(found):
                break
            others = self.of(window[offset])
            at = np.searchsorted(others, found + offset)
            found = found[others[np.minimum(at, len(others) - 1)] == found + offset]
        return found

    def near(self, window: np.ndarray, slop: int) -> np.ndarray:
        """First places of stretches of len(window) + slop places, within a document, that hold all its words."""
        words, need = np.unique(window, return_counts=True)
        order = np.argsort(self.length[words], kind="stable")
        span = len(window) + slop
        rarest = self.of(words[order[0]])
        doc = self.owner(rarest)
        # A stretch may begin up to span - 1 places before the rarest word.
        starts = np.maximum(rarest[:, None] - np.arange(span), self.starts[doc][:, None]).ravel()
        ends = np.minimum(starts + span, np.repeat(self.starts[doc] + self.sizes[doc], span))
        for k in order:
            others = self.of(words[k])
            held = np.searchsorted(others, ends) - np.searchsorted(others, starts) >= need[k]
            starts, ends = starts[held], ends[held]
        return np.unique(starts)


def search(index: DataFrame, part: Part, slop: int | None = None) -> DataFrame:
    """Matches of a part of a benchmark, a row for every document.

    block and row tell documents apart, also where ids repeat. spans: merged stretches of hit words,
    counted from 0, the end not included; items: ids with an exact match; near: ids with a
    proximity match (none without `slop`).
    """
    shared = index.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                yield _matches(Block(row, part), row, part, slop)

    return index.mapInArrow(run, MATCHES)


def _matches(block: Block, row: dict, part: Part, slop: int | None) -> pa.RecordBatch:
    n = len(block.sizes)
    items: list[set] = [set() for _ in range(n)]
    near: list[set] = [set() for _ in range(n)]
    hits = np.zeros(int(block.sizes.sum()) + n + 1, np.int32)
    padded = np.append(block.length, np.iinfo(np.int64).max)
    possible = np.flatnonzero(padded[part.windows].min(axis=1) > 0)
    for k in possible:
        window = part.windows[k][part.windows[k] >= 0]
        at = block.phrases(window)
        hits[at] += 1
        hits[at + len(window)] -= 1
        for doc in np.unique(block.owner(at)):
            items[doc].update(part.items[k])
        if slop is not None:
            for doc in np.unique(block.owner(block.near(window, slop))):
                near[doc].update(part.items[k])
    edges = np.diff((np.cumsum(hits) > 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = block.owner(starts)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    starts, ends = starts - block.starts[owner], ends - block.starts[owner]
    spans = pa.StructArray.from_arrays(
        [pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], ["start", "end"]
    )
    return pa.record_batch(
        [
            pa.array([row["block"]] * n, pa.int64()),
            pa.array(np.arange(n, dtype=np.int32)),
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(block.sizes),
            pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans),
            pa.array([sorted(found) for found in items], pa.list_(pa.string())),
            pa.array([sorted(found) for found in near], pa.list_(pa.string())),
        ],
        ["block", "row", "doc_id", "n_words", "spans", "items", "near"],
    )


def hit_words(spans: str) -> Column:
    """Number of words in the union of the spans, which may overlap."""
    return F.expr(
        f"aggregate(array_sort({spans}), (0L AS hit, 0 AS upto),"
        " (a, s) -> (a.hit + greatest(s.end - greatest(a.upto, s.start), 0) AS hit, greatest(a.upto, s.end) AS upto),"
        " a -> a.hit)"
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, slop: int | None = None, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_words, spans, items, near for each row of `docs`; spans of several parts may overlap."""
    index = build_index(docs)
    found = [search(index, part, slop) for part in benchmark_parts(benchmark, part_words)] or [
        search(index, parts_of([]), slop)
    ]
    if len(found) == 1:
        return found[0].drop("block", "row")
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    lists = [F.flatten(F.collect_list(name)).alias(name) for name in ("spans", "items", "near")]
    return (
        rows.groupBy("block", "row")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_words").alias("n_words"), *lists)
        .select("doc_id", "n_words", "spans", F.array_distinct("items").alias("items"), F.array_distinct("near").alias("near"))
    )


def contamination_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row."""
    return found.select(
        "doc_id",
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, without an occurrence of any benchmark window.

    Rows that repeat an id are one document here: they go if one of them is contaminated. A row with
    a null id can't be named and stays.
    """
    dropped = find_contamination(docs, benchmark).where("size(spans) > 0").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
