"""How the sources of a language differ in their use of terms; term strings move as late as possible.

Terms are runs of letters (A-Z lower-cased) and of characters beyond ASCII. A language keeps the terms that at
least `least` of its documents hold. A term's share in a group (lang, source), or in a whole language, is a
smoothed whole number of billionths; `pair` compares the groups of a language over all kept terms, `term`
lists what a group uses more than its language.

1. Counting. A task cuts a slice of texts into words, numbers its different words and writes one row per
   lang, source and word: digest, occurrences, documents, and the string. This table is not shuffled.
2. Digests. Occurrences and documents are summed by a 64-bit digest; the string column isn't read. Digests whose
   documents reach `least` are candidates: two terms of one digest can only make it larger, so none is missed.
3. Collisions. Of the candidates alone, found by a bitmap, the smallest and the largest string per language and
   digest are taken and stored. Where they differ, the rows are counted again by digest and string. So the result is
   exact whatever the digest (tests use one of few bits).
4. Shares are compared in blocks of terms: a block is a matrix of (terms x sources) whole numbers, and gives one
   row per pair of sources. Blocks are cut by digest, so a frequent language makes more blocks, not larger ones.
5. Strings are joined to the ranks that are put out. Ranks up to `top` by value come first, with all rows that tie
   with the last of them; the strings then settle the ties.

All arithmetic is on whole numbers. Null lang, source or text is the empty string, rows with the same id are
documents of their own, an empty text belongs to its group without terms, a long text is a slice of its own, an empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import discard, encoded, in_slices, stored
from tunemill.llm.line_dedup import bitmap, maybe_in

LEAST, TOP, SMOOTH, UNIT = 30, 50, 5, 1_000_000_000
#: Bytes of text that are counted together: the more, the fewer rows.
COUNT_BYTES = 16_000_000
#: Cells of a block's matrix, 8 bytes each; as many as pairs of sources at least, so that a block gives no more than it takes.
BLOCK_CELLS = 1 << 15

_LETTERS = bytes(
    byte if 0x61 <= byte <= 0x7A or byte >= 0x80 else byte + 32 if 0x41 <= byte <= 0x5A else 0x20 for byte in range(256)
)
_COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())]
)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and which text each is from."""
    coded = [encoded(text) for text in texts.to_pylist()]
    offsets = np.cumsum([0, *map(len, coded)]).astype(np.int64)
    count, letters = len(coded), b"".join(coded)
    del coded
    letters = letters.translate(_LETTERS)
    cut = pa.LargeStringArray.from_buffers(count, pa.py_buffer(offsets), pa.py_buffer(letters))
    lists = pc.ascii_split_whitespace(cut)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), owner.filter(some).to_numpy(zero_copy_only=False).astype(np.int64)


def counted_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row per lang, source and word of a slice of documents; a group's row without a word tells that it occurs."""
    groups = pa.table({"lang": batch["lang"], "source": batch["source"]}).group_by(["lang", "source"]).aggregate([])
    place = {pair: i for i, pair in enumerate(zip(groups["lang"].to_pylist(), groups["source"].to_pylist()))}
    group_of = np.array([place[p] for p in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())], np.int64)
    words, owner = _words(batch["text"])
    coded = words.dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    width = max(len(names), 1)
    # A slice's words take many times its bytes: what isn't needed any more goes at once.
    del words
    owner *= width
    owner += codes
    del coded, codes
    in_docs, times = np.unique(owner, return_counts=True)
    del owner
    keys, at = np.unique(group_of[in_docs // width] * width + in_docs % width, return_inverse=True)
    n = np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64)
    n_docs = np.bincount(at, minlength=len(keys)).astype(np.int64)
    group = pa.array(np.concatenate([keys // width, np.arange(len(groups))]))
    term = pc.cast(names.take(pa.array(keys % width)), pa.string())
    nothing = np.zeros(len(groups), np.int64)
    return pa.record_batch(
        [
            groups["lang"].combine_chunks().take(group),
            groups["source"].combine_chunks().take(group),
            pa.concat_arrays([term, pa.nulls(len(groups), pa.string())]),
            pa.array(np.concatenate([n, nothing])),
            pa.array(np.concatenate([n_docs, nothing])),
        ],
        schema=_COUNTED,
    )


def counted(docs: DataFrame, bits: int) -> DataFrame:
    """lang, source, digest, term, n, n_docs as the tasks count them; digest and term are null for a bare group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in in_slices(batches, limit=COUNT_BYTES):
                yield counted_slice(part)
        finally:
            # The worker waits for other tasks while Spark's own stages need the memory.
            pa.default_memory_pool().release_unused()

    given = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = given.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    digest = F.when(F.col("term").isNotNull(), F.shiftrightunsigned(F.xxhash64("term"), 64 - bits))
    return rows.select("lang", "source", digest.alias("digest"), "term", "n", "n_docs")


def kept_counts(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """lang, source, digest, split, n of the kept terms, one row per term and source that has it; and lang, digest, term.

    `split` is the term itself where its digest stands for several terms of the language, else empty; then
    the second table has the digest's only term. Both are stored.
    """
    sums = rows.where("digest IS NOT NULL").groupBy("lang", "source", "digest")
    sums = stored(sums.agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "digests")
    frequent = sums.groupBy("lang", "digest").agg(F.sum("n_docs").alias("all_docs")).where(F.col("all_docs") >= least)
    frequent = stored(frequent.select("lang", "digest"), "frequent")
    wanted = stored(bitmap(frequent, "digest"), "bitmap")
    named = rows.where("digest IS NOT NULL").select("lang", "source", "digest", "term", "n", "n_docs")
    named = named.withColumn("_bits", wanted.scalar()).where(maybe_in(F.col("_bits"), F.col("digest"))).drop("_bits")
    # Repeats go first, by hash; the smallest and the largest string of what is left take a sort.
    ends = named.select("lang", "digest", "term").distinct().groupBy("lang", "digest")
    names = stored(ends.agg(F.min("term").alias("term"), F.max("term").alias("high")), "names")
    # Stored, so that Spark knows how few they are and sends them to the rows.
    clashes = stored(names.where("term <> high").select("lang", "digest"), "clashes")
    key = ["lang", "digest"]
    plain = sums.join(frequent, key, "left_semi").join(clashes, key, "left_anti")
    again = named.join(clashes, key, "left_semi").groupBy("lang", "source", "digest", "term")
    again = again.agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    enough = again.groupBy(*key, "term").agg(F.sum("n_docs").alias("all_docs")).where(F.col("all_docs") >= least)
    apart = again.join(enough, [*key, "term"], "left_semi")
    kept = plain.select("lang", "source", "digest", F.lit("").alias("split"), "n").union(
        apart.select("lang", "source", "digest", F.col("term").alias("split"), "n")
    )
    kept = stored(kept, "kept")
    discard(sums, frequent, wanted, clashes)
    return kept, names.select("lang", "digest", "term")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * terms)), null where there is no term at all.

    Decimals, as the product may pass 64 bits.
    """
    top = F.lit(UNIT).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(19,0)")
    return F.call_function("div", top, F.nullif((total + SMOOTH * terms).cast("decimal(20,0)"), F.lit(0))) + 1


def shares(rows: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, n_terms, total, lang_total) per group, and `kept` with its share p and its language's share q."""
    occurring = rows.select("lang", "source").distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_term = kept.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"))
    per_lang = per_term.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left")
    groups = stored(groups.na.fill(0, ["total", "n_terms", "lang_total"]), "groups")
    both = kept.join(per_term, ["lang", "digest", "split"])
    p, q = (_share(F.col(n), F.col(total), F.col("n_terms")) for n, total in (("n", "total"), ("lang_n", "lang_total")))
    return groups, both.join(groups, ["lang", "source"]).select("lang", "source", "digest", "split", p.alias("p"), q.alias("q"))


def _compare(block: pa.Table) -> pa.Table:
    """Summed differences of all pairs of sources in a block; rows without a digest give the shares of absent terms."""
    source = block["source"].combine_chunks().dictionary_encode()
    names, column = source.dictionary, source.indices.to_numpy(zero_copy_only=False)
    p = block["p"].to_numpy()
    bare = block["digest"].is_null().to_numpy(zero_copy_only=False)
    absent = np.zeros(len(names), np.int64)
    absent[column[bare]] = p[bare]
    terms = pa.table({"digest": block["digest"], "split": block["split"]}).filter(pa.array(~bare))
    line = {t: i for i, t in enumerate(dict.fromkeys(zip(terms["digest"].to_pylist(), terms["split"].to_pylist())))}
    matrix = np.repeat(absent[None], len(line), axis=0)
    at = [line[t] for t in zip(terms["digest"].to_pylist(), terms["split"].to_pylist())]
    matrix[at, column[~bare]] = p[~bare]
    values = [np.abs(matrix - matrix[:, i : i + 1]).sum(axis=0) for i in range(len(names))]
    first, second = np.divmod(np.arange(len(names) ** 2), max(len(names), 1))
    other = first != second
    lang = pa.array([block["lang"][0].as_py()] * int(other.sum()), pa.string())
    value = np.concatenate([*values, np.empty(0, np.int64)])[other]
    return pa.table(
        {"lang": lang, "source": names.take(pa.array(first[other])), "item": names.take(pa.array(second[other])), "value": pa.array(value)}
    )


def pair_part(groups: DataFrame, found: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the lang), value."""
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_sources"), F.first("n_terms").alias("n_terms"))
    # Every language has one block at least.
    cells = F.greatest(F.col("n_sources") * F.col("n_sources"), F.lit(BLOCK_CELLS))
    blocks = F.ceil(F.col("n_terms") * F.col("n_sources") / cells)
    langs = langs.select("lang", F.greatest(blocks, F.lit(1)).cast("int").alias("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    absent = groups.join(langs, "lang").select(
        "lang", every, "source", F.lit(None).cast("long").alias("digest"), F.lit("").alias("split"),
        _share(F.lit(0).cast("long"), F.col("total"), F.col("n_terms")).alias("p"),
    )
    # In a language without kept terms there is nothing to compare.
    absent = absent.withColumn("p", F.coalesce("p", F.lit(0).cast("long")))
    block = F.pmod(F.xxhash64("digest", "split"), F.col("blocks")).cast("int")
    present = found.join(langs, "lang").select("lang", block.alias("block"), "source", "digest", "split", "p")
    compared = absent.union(present).groupBy("lang", "block").applyInArrow(_compare, "lang string, source string, item string, value long")
    return compared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_part(names: DataFrame, found: DataFrame, top: int) -> DataFrame:
    """lang, source, item (a term used more than in the language), value, up to `top` a group and those that tie with the last."""
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    ranked = found.where("p > q").select("lang", "source", "digest", "split", (F.col("p") - F.col("q")).alias("value"))
    ranked = ranked.withColumn("_rank", F.rank().over(by_value)).where(F.col("_rank") <= top)
    late = ranked.join(names, ["lang", "digest"])
    item = F.when(F.col("split") == "", F.col("term")).otherwise(F.col("split"))
    return late.select("lang", "source", item.alias("item"), "value")


def source_divergence(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank (from 1, by falling value, then by item)."""
    rows = stored(counted(docs, bits), "counted")
    kept, names = kept_counts(rows, least)
    groups, found = shares(rows, kept)
    found = stored(found, "shares")
    parts = pair_part(groups, found).withColumn("part", F.lit("pair")).unionByName(
        term_part(names, found, top).withColumn("part", F.lit("term"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
