"""Exact duplicates by combining in three steps, comparing whole texts in each.

1. Each task combines equal texts of what it has read (the partial aggregation of Spark, whose keys
   are digest, salt and the whole text).
2. Salted groups merge these: a text that a third of all rows share goes to `salts` tasks.
3. The salts' winners, one row per salt and text at most, are merged by digest and text.

Rows find their group's winner by digest and salt: the winner goes to each salt that the group has, so no task gets more
than one salt of a group. Two different texts with one SHA-256 are an error there.

Null texts count as empty, so all of them are equal. A null id never wins against another id; if a
group has only null ids, its keep_id is null and the first of its rows stays. Rows that repeat both
id and text can't be told apart; one of them stays. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import SPACE

SALTS = 64


def digests(docs: DataFrame, salts: int) -> DataFrame:
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    return docs.select("doc_id", text.alias("text"), salt.alias("salt")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def winners(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, keep_id, group_size, salts (those that its rows have) for each different text."""
    per_salt = digests(docs, salts).groupBy("digest", "salt", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    # At most one row per salt and text is left, so the lists hold `salts` values at most.
    per_text = per_salt.groupBy("digest", "text").agg(
        F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")
    )
    clash = F.raise_error(F.concat(F.lit("two texts with the SHA-256 "), F.hex("digest")))
    return (
        per_text.groupBy("digest")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.count("*").alias("texts"),
            F.first("salts").alias("salts"),
        )
        .select("digest", "keep_id", "salts", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(clash).alias("group_size"))
    )


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of `docs`."""
    # Dealt out as the join needs it, so that the count needs no shuffle of its own.
    rows = digests(docs, salts).select("digest", "salt", "doc_id").repartition("digest", "salt")
    rows = rows.groupBy("digest", "salt", "doc_id").agg(F.count("*").cast("int").alias("times"))
    winner = winners(docs, salts).select("digest", F.explode("salts").alias("salt"), "keep_id", "group_size")
    joined = rows.join(winner, ["digest", "salt"])
    return joined.select(
        "doc_id", "keep_id", "group_size", "digest", F.explode(F.sequence(F.lit(1), "times")).alias("nth")
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; needs ids that are unique and not null."""
    return docs.join(exact_dedup(docs, salts).where("kept").select("doc_id"), "doc_id", "left_semi")
