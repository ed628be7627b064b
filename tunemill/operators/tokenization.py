"""Vocabulary building and tokenization."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunemill.functions.tokens import (
    BOS_ID,
    FIRST_TOKEN_ID,
    MAX_LENGTH,
    UNK_ID,
    split_tokens,
)
from tunemill.operators.heavy_hitters import most_frequent

_TOKENS_PER_SLOT = 4
_SALTS = 16


@dataclass(frozen=True)
class Vocabulary:
    """`table` is (token STRING, token_id INT) with at most `size` rows."""

    table: DataFrame
    size: int

    @staticmethod
    def read(spark: SparkSession, path: str) -> Vocabulary:
        table = spark.read.parquet(path)
        return Vocabulary(table, table.count())


def build_vocab(texts: DataFrame, size: int, text: str = "text") -> Vocabulary:
    """The `size` most frequent tokens, ties in token order, with ids after the reserved ones."""
    counts = (
        texts.select(F.explode(split_tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _numbered(counts.orderBy(F.desc("n"), F.asc("token")).limit(size), size)


def build_vocab_bounded(texts: DataFrame, size: int, text: str = "text") -> Vocabulary:
    """The same as `build_vocab`, by summaries of bounded size: for texts with very many different tokens.

    Reads the texts twice, but shuffles a few times `size` tokens of each task at most (see heavy_hitters).
    """
    return _numbered(most_frequent(texts.select(split_tokens(F.col(text)).alias("tokens")), size), size)


def _numbered(top: DataFrame, size: int) -> Vocabulary:
    # Only the `size` rows that are left go through this window.
    token_id = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("token"))) + (FIRST_TOKEN_ID - 1)
    return Vocabulary(top.select("token", token_id.cast("int").alias("token_id")), size)


def tokenize(
    df: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    id_column: str = "id",
    max_length: int | None = MAX_LENGTH,
    add_bos: bool = True,
    joined: bool = False,
) -> DataFrame:
    """Adds `input_ids`, `attention_mask` and `n_tokens`.

    Tokens outside the vocabulary get the unknown id. `max_length` cuts the tail, counting
    the BOS id; None keeps every token.

    The vocabulary travels with the tasks as one value. With `joined` it is joined instead, for
    a vocabulary too large for that; the result is the same. The join puts rows together by
    `id_column`, so there a NULL or repeated id is an error.
    """
    # A missing text has no tokens.
    tokens = F.coalesce(split_tokens(F.col(text)), F.array().cast("array<string>"))
    if max_length is not None:
        # Cutting before the lookup gives the same ids with less to look up.
        tokens = F.slice(tokens, 1, max_length - int(add_bos))
    cut = df.withColumn("_tokens", tokens)
    # Told by the tokens, so that nothing is looked up where only lengths or masks are wanted.
    cut = cut.withColumn("_n", F.size("_tokens") + int(add_bos))
    if joined:
        encoded = _encode_by_join(cut, F.col("_tokens"), vocabulary, id_column)
    else:
        encoded = _encode_inline(cut, F.col("_tokens"), vocabulary)
    ids = F.col("_ids")
    if add_bos:
        ids = F.concat(F.array(F.lit(BOS_ID)), ids)
    n_tokens = F.col("_n")
    return (
        encoded.withColumn("input_ids", ids)
        .withColumn("attention_mask", F.array_repeat(F.lit(1).cast("tinyint"), n_tokens))
        .withColumn("n_tokens", n_tokens)
        .drop("_ids", "_tokens", "_n")
    )


def _encode_inline(df: DataFrame, tokens: Column, vocabulary: Vocabulary) -> DataFrame:
    # The vocabulary becomes one value: an array of small maps, picked by the token's hash.
    # Each token is looked up where its row is, with no row explosion and no shuffle.
    slots = max(1, vocabulary.size // _TOKENS_PER_SLOT)

    def slot(token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(slots)).cast("int")

    entry = F.struct("token", "token_id")
    known = vocabulary.table.select(slot(F.col("token")).alias("slot"), entry.alias("entry"))
    no_entry = F.lit(None).cast(known.schema["entry"].dataType)
    every_slot = df.sparkSession.range(slots).select(
        F.col("id").cast("int").alias("slot"), no_entry.alias("entry")
    )
    in_order = F.sort_array(F.collect_list(F.struct("slot", "entries")))
    lookup = (
        known.union(every_slot)
        .groupBy("slot")
        .agg(F.collect_list("entry").alias("entries"))
        .agg(F.transform(in_order, lambda s: F.map_from_entries(s["entries"])).alias("lookup"))
        .scalar()
    )

    def encode(table: Column) -> Column:
        return F.transform(
            tokens,
            lambda t: F.coalesce(
                F.element_at(F.element_at(table, slot(t) + 1), t), F.lit(UNK_ID)
            ),
        )

    # One select after the subquery column, so that the two merge and the value is not
    # copied into each row.
    return df.withColumn("_lookup", lookup).select(
        *df.columns, F.transform(F.array("_lookup"), encode)[0].alias("_ids")
    )


def _encode_by_join(
    df: DataFrame, tokens: Column, vocabulary: Vocabulary, id_column: str
) -> DataFrame:
    missing = F.raise_error(F.lit(f"NULL in {id_column}"))
    df = df.withColumn(id_column, F.coalesce(F.col(id_column), missing.cast(df.schema[id_column].dataType)))
    # A frequent token would fill one join partition, so it is dealt out by its place as well. The
    # salt is worked out from the place and doesn't travel.
    exploded = df.select(id_column, F.posexplode(tokens).alias("pos", "token"))
    salted = vocabulary.table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    known = (exploded["token"] == salted["token"]) & (F.pmod(exploded["pos"], F.lit(_SALTS)) == salted["salt"])
    # Place and id in one number, the place first. The rows are dealt out as they are: few of a row's
    # tokens meet in a task before, so lists put together there would only be larger.
    found = F.shiftleft(F.col("pos").cast("bigint"), 32).bitwiseOR(F.coalesce("token_id", F.lit(UNK_ID)).cast("bigint"))
    placed = exploded.join(salted, known, "left").select(id_column, found.alias("found")).repartition(id_column)
    repeated = F.raise_error(F.concat(F.lit(f"repeated {id_column} "), F.col(id_column).cast("string")))
    # Places count up from 0, so a second row of the same id shows in their number.
    encoded = (
        placed.groupBy(id_column)
        .agg(F.sort_array(F.collect_list("found")).alias("_found"), F.max("found").alias("_last"))
        .select(
            id_column,
            F.when(
                F.size("_found") == F.shiftright("_last", 32) + 1,
                F.transform("_found", lambda one: one.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")),
            )
            .otherwise(repeated.cast("array<int>"))
            .alias("_ids"),
        )
    )
    empty = F.array().cast("array<int>")
    return (
        df.join(encoded, id_column, "left")
        .select(*df.columns, F.coalesce("_ids", empty).alias("_ids"))
    )
