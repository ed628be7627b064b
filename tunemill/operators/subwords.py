"""Byte-level subword coding by a file of ranks.

A text is cut into words by a pattern, in the JVM; a word's bytes are merged pair by pair, lowest rank first. Only the
words travel to Python, as Arrow lists: the different words of a part of a batch are merged once, and their
ids are put in place by number. No row is exploded and nothing is shuffled, so a frequent word is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions.byte_pairs import TextCoder, WordCoder
from tunemill.functions.tokens import MAX_LENGTH, attention_mask

# The words that the public byte-level vocabularies were made from.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A table of ranks travels to all tasks; a larger one is an error.
MAX_PIECES, MAX_BYTES = 1 << 20, 1 << 26
#: Words coded together: what is worked out for them takes memory besides the batch. One longer text is coded at once.
WORDS_AT_A_TIME = 1 << 16


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(piece BINARY, token_id INT) from a text file with a piece in base 64 and its rank on each line."""
    line = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(F.unbase64(line[0]).alias("piece"), line[1].cast("int").alias("token_id"))


def ranks_value(ranks: DataFrame) -> Broadcast:
    """The table as a broadcast dict, its size checked first.

    Pieces and ids are unique and not NULL, and every single byte is a piece, so any text can be coded.
    """
    size = ranks.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("piece").alias("pieces"),
        F.count_distinct("token_id").alias("ids"),
        F.coalesce(F.sum(F.octet_length("piece")), F.lit(0)).alias("bytes"),
        F.count_distinct(F.when(F.octet_length("piece") == 1, F.col("piece"))).alias("singles"),
    ).first()
    if size["rows"] > MAX_PIECES or size["bytes"] > MAX_BYTES:
        raise ValueError(f"a table of {size['rows']} pieces, {size['bytes']} bytes, is too large to send to all tasks")
    if not size["rows"] == size["pieces"] == size["ids"]:
        raise ValueError("pieces and ids have to be unique and not NULL")
    if size["singles"] < 256:
        raise ValueError(f"only {size['singles']} of 256 single bytes are pieces")
    known = {bytes(r["piece"]): r["token_id"] for r in ranks.select("piece", "token_id").collect()}
    return ranks.sparkSession.sparkContext.broadcast(known)


def split_words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """The words of a text in order; together they are the text again. A NULL text has none."""
    # White space as in Unicode, not only in ASCII.
    words = F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def tokenize_subwords(
    df: DataFrame,
    ranks: DataFrame | Broadcast,
    text: str = "text",
    max_length: int | None = MAX_LENGTH,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """Adds `input_ids`, `attention_mask` and `n_tokens`; `max_length` cuts the tail, None keeps every id."""
    known = ranks_value(ranks) if isinstance(ranks, DataFrame) else ranks
    words = split_words(F.col(text), pattern)
    if max_length is not None:
        # A word has one id at least, so no word beyond these is needed.
        words = F.slice(words, 1, max_length)
    ids = _coded(known)(words)
    if max_length is not None:
        ids = F.slice(ids, 1, max_length)
    return (
        df.withColumn("input_ids", ids)
        .withColumn("attention_mask", attention_mask(F.col("input_ids")))
        .withColumn("n_tokens", F.size("input_ids"))
    )


def _coded(known: Broadcast):
    import pyarrow as pa

    def parts(batches):
        for batch in batches:
            ends, start = batch.offsets.to_numpy(), 0
            while start < len(batch):
                stop = max(start + 1, int(ends.searchsorted(ends[start] + WORDS_AT_A_TIME, "right")) - 1)
                yield batch.slice(start, stop - start)
                start = stop

    def code(batches):
        import numpy as np

        coder = WordCoder(known.value)
        for lists in parts(batches):
            words = lists.flatten().dictionary_encode()
            pieces = [coder.ids(word) for word in words.dictionary.to_pylist()]
            ends = np.cumsum([0, *map(len, pieces)]).astype(np.int32)
            flat = np.fromiter((i for ids in pieces for i in ids), np.int32, ends[-1])
            coded = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            place = words.indices.to_numpy()
            # Ids before each word of the batch; a row ends where its last word does.
            before = np.concatenate([[0], np.cumsum(np.diff(ends)[place])]).astype(np.int32)
            rows = lists.offsets.to_numpy()
            yield pa.ListArray.from_arrays(pa.array(before[rows - rows[0]]), coded.take(words.indices).flatten())

    code.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(code, "array<int>")


def text_coder(known: Broadcast, pattern: str = WORD_PATTERN):
    """A loader for `tokenize_with`: the same coding as a tokenizer of whole texts."""
    return lambda: TextCoder(known.value, pattern)


def decode_subwords(df: DataFrame, ranks: DataFrame, ids: str = "input_ids", name: str = "text") -> DataFrame:
    """Adds `name`, the text that the ids stand for. An id that isn't in the table is an error; a NULL list gives NULL.

    Ids that were cut inside a character give bytes that are no valid text; those read as U+FFFD.
    """
    last = ranks.agg(F.max("token_id")).scalar()
    every = ranks.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), last)).alias("token_id"))
    in_order = F.sort_array(F.collect_list(F.struct("token_id", F.hex("piece").alias("hex"))))
    # Pieces by id as one value, read where the row is.
    pieces = every.join(ranks, "token_id", "left").agg(F.transform(in_order, lambda r: r["hex"])).scalar()

    def decode(table: Column) -> Column:
        unknown = F.raise_error(F.lit("an id that stands for no piece")).cast("string")
        hexes = F.transform(ids, lambda i: F.coalesce(F.get(table, i), unknown))
        return F.make_valid_utf8(F.unhex(F.array_join(hexes, "")).cast("string"))

    columns = [c for c in df.columns if c != name]
    return df.withColumn("_pieces", pieces).select(*columns, F.transform(F.array("_pieces"), decode)[0].alias(name))
