"""Repeated passages: words covered by a window that also starts in a document with a smaller id.

1. Names. Each task recompresses its documents (see recompression). A symbol whose context fits into a
   window and that no other document has proves that none of the windows around that context is
   repeated. Which symbols two documents have is found out by dealing them by hash.
2. Windows. A window stays in question if all symbols within it are shared. These windows are named by
   two 64-bit hashes of their words, dealt by hash, and the smallest id of each is found.
3. Words. The windows of a document that a smaller id has too cover the words to remove.

Before anything is dealt out, a task combines what its own documents share: a symbol or window goes out
once for a slice of some megabytes, whatever the number of its copies there.

Windows are judged on the input. A null text has no words. A null id is neither smaller nor larger
than another: its row removes nothing and loses nothing. Rows that repeat an id are one document to
each other, so they don't remove each other's words. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tunemill.llm.common import encoded, in_slices, per_row, space_words
from tunemill.llm.recompression import END, mixed, recompress

WINDOW = 50
#: Bytes of text to a bucket: fixes how many buckets symbols and windows are dealt to.
BUCKET_BYTES = 32_000_000
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))

#: Keys of documents on their way to a bucket: ids in runs, `times` keys for each. `direct`: settled already.
MESSAGE = "bucket int, direct boolean, docs binary, times binary, keys binary, checks binary"


def word_names(words: list[bytes]) -> np.ndarray:
    """64-bit names of words, never END."""
    return np.fromiter(map(xxh64_intdigest, words, repeat(50)), np.uint64, len(words)) | np.uint64(1)


class Slice:
    """Words of some documents in one array, with END before and after each."""

    def __init__(self, texts: list[bytes]):
        words = [space_words(text) for text in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes
        flat = [b"", *(word for one in words for word in (*one, b""))]
        self.names = word_names(flat)
        self.names[0] = END
        self.names[self.starts + self.sizes] = END

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def windows(self) -> np.ndarray:
        """Starts of all windows."""
        fit = np.maximum(self.sizes - WINDOW + 1, 0)
        first = np.cumsum(fit) - fit
        return np.arange(fit.sum()) + np.repeat(self.starts - first, fit)

    def hashes(self, at: np.ndarray, which: int) -> np.ndarray:
        """Of the windows that start at `at`: a polynomial in the words' names modulo 2^64."""
        base = _BASES[which] | np.uint64(1)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        names = mixed(self.names + np.uint64(which))
        sums = np.append(np.uint64(0), np.cumsum(names * _powers(base, len(names))))
        return mixed((sums[at + WINDOW] - sums[at]) * _powers(inverse, len(names))[at])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base)
    powers[:1] = 1
    return np.cumprod(powers)


def _in_context(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, name, and context of the symbols that can speak about a window."""
    symbols, low, high = recompress(part.names)
    fits = (high - low < WINDOW) & (low > 0)
    symbols, low, high = symbols[fits], low[fits], high[fits]
    doc = part.owner(low)
    # The END before a document belongs to the one before, whose words `high` is beyond.
    inside = high < part.starts[doc] + part.sizes[doc]
    inside &= part.sizes[doc] >= WINDOW
    return doc[inside], symbols[inside], low[inside], high[inside]


def _rows(bucket_of: np.ndarray, buckets: int, direct: bool, docs, keys, checks=None) -> list[tuple]:
    """A row per bucket: its documents with the number of their keys, and the keys."""
    order = np.lexsort((docs, bucket_of))
    cuts = np.searchsorted(bucket_of[order], np.arange(buckets + 1, dtype=np.uint64))
    rows = []
    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
        some = order[cuts[bucket] : cuts[bucket + 1]]
        ids = docs[some]
        at = np.flatnonzero(_changes(ids))
        times = np.diff(np.append(at, len(ids))).astype(np.int32)
        extra = checks[some].tobytes() if checks is not None else b""
        rows.append((bucket, direct, ids[at].tobytes(), times.tobytes(), keys[some].tobytes(), extra))
    return rows


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
    names = ["bucket", "direct", "docs", "times", "keys", "checks"]
    return pa.record_batch([pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], names)


def _home(docs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in which a document's keys meet again."""
    return mixed(docs.astype(np.int64).view(np.uint64)) % np.uint64(buckets)


def _messages(buckets: int, doc_ids, keys, checks, local_ids, local_keys) -> pa.RecordBatch:
    """What goes out to be compared, and what the task has settled by itself."""
    out = _rows(keys % np.uint64(buckets), buckets, False, doc_ids, keys, checks)
    return _table(out + _rows(_home(local_ids, buckets), buckets, True, local_ids, local_keys))


def _symbol_messages(batch: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    ids = batch["doc_id"].to_numpy()
    doc, symbols, _, _ = _in_context(Slice([encoded(text) for text in batch["text"].to_pylist()]))
    doc_ids = ids[doc]
    order = np.lexsort((doc_ids, symbols))
    symbols, doc_ids = symbols[order], doc_ids[order]
    first = _changes(symbols)
    fresh = first | _changes(doc_ids)
    symbols, doc_ids, first = symbols[fresh], doc_ids[fresh], first[fresh]
    shared = ~(first & np.append(first[1:], True))
    return _messages(buckets, doc_ids[first], symbols[first], None, doc_ids[shared], symbols[shared])


def _changes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _read(table: pa.Table, direct: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = table.filter(pc.equal(table["direct"], direct))
    docs, times, keys, checks = (
        np.frombuffer(b"".join(rows[name].to_pylist()), kind)
        for name, kind in (("docs", np.int64), ("times", np.int32), ("keys", np.uint64), ("checks", np.uint64))
    )
    return np.repeat(docs, times), keys, checks


def _sent_home(table: pa.Table, buckets: int, docs: np.ndarray, keys: np.ndarray) -> pa.Table:
    """Settled keys, those that came settled among them, for their documents' buckets."""
    local_docs, local_keys, _ = _read(table, True)
    docs, keys = np.concatenate([docs, local_docs]), np.concatenate([keys, local_keys])
    return pa.Table.from_batches([_table(_rows(_home(docs, buckets), buckets, True, docs, keys))])


def _shared_symbols(table: pa.Table, buckets: int) -> pa.Table:
    """Symbols that more than one slice has; what one slice has twice is settled already."""
    docs, keys, _ = _read(table, False)
    order = np.argsort(keys, kind="stable")
    first = _changes(keys[order])
    shared = order[~(first & np.append(first[1:], True))]
    return _sent_home(table, buckets, docs[shared], keys[shared])


def _repeated_windows(table: pa.Table, buckets: int) -> pa.Table:
    """Windows with a smaller id in another slice, and those with one in their own."""
    docs, keys, checks = _read(table, False)
    order = np.lexsort((docs, checks, keys))
    docs, keys = docs[order], keys[order]
    first = _changes(keys) | _changes(checks[order])
    smallest = docs[np.maximum.accumulate(np.where(first, np.arange(len(docs)), 0))]
    later = docs > smallest
    return _sent_home(table, buckets, docs[later], keys[later])


def _per_document(table: pa.Table) -> pa.Table:
    docs, keys, _ = _read(table, True)
    order = np.argsort(docs, kind="stable")
    docs, keys = docs[order], keys[order]
    starts = np.flatnonzero(_changes(docs))
    ends = np.append(starts[1:], len(docs))
    found = [keys[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
    return pa.table({"doc_id": pa.array(docs[starts], pa.int64()), "flags": pa.array(found, pa.binary())})


def _known(part: Slice, flags: list, doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which (document, key) are among the documents' flags."""
    arrays = [np.frombuffer(flag or b"", np.uint64) for flag in flags]
    owner = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays]).astype(np.uint64)
    flagged = np.concatenate([*arrays, np.empty(0, np.uint64)])
    return np.isin(keys ^ mixed(doc.astype(np.uint64)), flagged ^ mixed(owner))


def _window_messages(batch: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    ids = batch["doc_id"].to_numpy()
    part = Slice([encoded(text) for text in batch["text"].to_pylist()])
    doc, symbols, low, high = _in_context(part)
    alone = ~_known(part, batch["flags"].to_pylist(), doc, symbols)
    ruled_out = np.zeros(len(part.names) + WINDOW + 1, np.int32)
    np.add.at(ruled_out, np.maximum(high[alone] - WINDOW + 1, 0), 1)
    np.add.at(ruled_out, low[alone] + 1, -1)
    at = part.windows()
    at = at[np.cumsum(ruled_out)[at] == 0]
    doc_ids = ids[part.owner(at)]
    keys, checks = part.hashes(at, 0), part.hashes(at, 1)
    order = np.lexsort((doc_ids, checks, keys))
    doc_ids, keys, checks = doc_ids[order], keys[order], checks[order]
    first = _changes(keys) | _changes(checks)
    smallest = doc_ids[np.maximum.accumulate(np.where(first, np.arange(len(doc_ids)), 0))]
    later = (doc_ids > smallest) & (_changes(doc_ids) | _changes(keys))
    return _messages(buckets, doc_ids[first], keys[first], checks[first], doc_ids[later], keys[later])


def _dealt(docs: DataFrame, messages: Callable, settle: Callable, buckets: int) -> DataFrame:
    """doc_id, flags: the keys that `settle` leaves of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            part = part.filter(pc.and_(part["doc_id"].is_valid(), part["text"].is_valid()))
            if part.num_rows:
                yield messages(part, buckets)

    def settled(table: pa.Table) -> pa.Table:
        return settle(table, buckets)

    home = docs.mapInArrow(run, MESSAGE).groupBy("bucket").applyInArrow(settled, MESSAGE)
    return home.groupBy("bucket").applyInArrow(_per_document, "doc_id long, flags binary")


def repeated_windows(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, text, flags (hashes of the windows to remove) for each row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // bucket_bytes
    texts = docs.select("doc_id", "text")
    symbols = _dealt(texts, _symbol_messages, _shared_symbols, buckets)
    # Both joins have the same left side, so Spark deals the texts out once.
    windows = _dealt(texts.join(symbols, "doc_id", "left"), _window_messages, _repeated_windows, buckets)
    return texts.join(windows, "doc_id", "left")


def substring_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row; `with_text` adds the kept words as kept_text."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, digests, kept_texts, sizes = [], [], [], []
        for text, flags in zip(batch["text"].to_pylist(), batch["flags"].to_pylist()):
            words = space_words(encoded(text))
            gone = 0
            if flags:
                part = Slice([encoded(text)])
                at = part.windows()
                hit = at[np.isin(part.hashes(at, 0), np.frombuffer(flags, np.uint64))] - part.starts[0]
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + WINDOW, -1)
                covered = (np.cumsum(cover)[:-1] > 0).tolist()
                gone = sum(covered)
                words = [word for word, drop in zip(words, covered) if not drop]
            kept = b" ".join(words)
            sizes.append(len(words) + gone)
            removed.append(gone)
            digests.append(sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept.decode("utf-8", "surrogatepass"))
        columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns, names = [*columns, pa.array(kept_texts, pa.string())], [*names, "kept_text"]
        return pa.record_batch(columns, names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return per_row(repeated_windows(docs, bucket_bytes), schema, rows)
