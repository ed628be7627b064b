"""The most frequent tokens, exactly, from summaries of bounded size.

Counting all tokens shuffles as many rows as there are different ones. Here each task keeps a summary of at most `capacity`
tokens, so the first shuffle is bounded by capacity x tasks, and the second, of exact counts, by candidates x tasks.

A summary that grows too long takes the count of its (capacity + 1)-th token off all counts and drops what is left with none. What
it has taken off in all is its error: a token occurs in the task at least as often as the summary says, and at most by
the error more often. Over all tasks the counts and the errors add up. With `floor` the size-th largest sum of counts, a
token whose sum and the sum of errors stay below `floor` can't be among the `size` most frequent. If the errors alone
stay below it, no token that all summaries lack can be either, and the candidates are complete. Otherwise the pass is
repeated with a larger capacity; one that holds all tokens has no error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.sources.tables import written

#: Tokens in a summary for each one that is asked for, and how much larger the next try is.
SLACK, GROWTH = 4, 8


class Summary:
    """Counts of at most `capacity` tokens (twice that between two cuts), too small by `error` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.error, self.counts = capacity, 0, {}

    def add(self, tokens: list[str], counts: list[int]) -> None:
        for token, n in zip(tokens, counts):
            self.counts[token] = self.counts.get(token, 0) + n
            if len(self.counts) > 2 * self.capacity:
                self.cut()

    def cut(self) -> None:
        if len(self.counts) > self.capacity:
            taken = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.counts = {token: n - taken for token, n in self.counts.items() if n > taken}
            self.error += taken


def task_summaries(lists: DataFrame, tokens: str, capacity: int) -> DataFrame:
    """(token, n, error): each task's summary, and a row without a token for its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity)
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten().drop_null())
            summary.add(found.field("values").to_pylist(), found.field("counts").to_pylist())
        summary.cut()
        rows = [pa.array([*summary.counts, None], pa.string()), pa.array([*summary.counts.values(), 0], pa.int64())]
        yield pa.record_batch([*rows, pa.array([0] * len(summary.counts) + [summary.error], pa.int64())], ["token", "n", "error"])

    return lists.select(tokens).mapInArrow(run, "token string, n long, error long")


def candidates(lists: DataFrame, size: int, tokens: str = "tokens", capacity: int | None = None) -> tuple[DataFrame, bool]:
    """(token, n) with all that can be among the `size` most frequent, and whether n is exact already. A stored table."""
    capacity = capacity or SLACK * size
    while True:
        sums = task_summaries(lists, tokens, capacity).groupBy("token").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
        sums = written(sums, "summaries")
        error = sums.where("token IS NULL").agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
        held = sums.where("token IS NOT NULL").select("token", "n")
        if error == 0:
            return held, True
        # The size-th largest; none if the summaries hold fewer tokens.
        floor = held.orderBy(F.desc("n")).offset(size - 1).limit(1).first()
        if floor and error < floor["n"]:
            return written(held.where(F.col("n") + F.lit(error) >= F.lit(floor["n"])), "candidates"), False
        capacity *= GROWTH


def most_frequent(lists: DataFrame, size: int, tokens: str = "tokens", capacity: int | None = None) -> DataFrame:
    """(token, n): the `size` most frequent tokens of the lists in column `tokens`, ties in token order, with their exact counts.

    NULL lists and NULL tokens count as nothing.
    """
    held, exact = candidates(lists, size, tokens, capacity)
    if not exact:
        # The candidates are a written table: Spark sees its size and sends it to all tasks if it is small.
        every = lists.select(F.explode(tokens).alias("token"))
        held = every.join(held.select("token"), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return held.orderBy(F.desc("n"), F.asc("token")).limit(size)
