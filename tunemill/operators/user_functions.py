"""User code on tables, where column expressions cannot say it.

User functions travel with the job, so the executors need no copy of this package; what they import, such as
`packed_rows` here or a subword coder, they need there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tunemill.functions.integers import whole_div
from tunemill.functions.tokens import MAX_LENGTH, attention_mask


def map_rows(df: DataFrame, fn: Callable[[dict], dict], added: str) -> DataFrame:
    """Merges what `fn` returns for each row into the row; `added` declares its columns.

    `fn` sees Python values, NULL as None. Columns that are not in `added` pass by as they are.
    """
    new = StructType.fromDDL(added)
    names = new.fieldNames()
    kept = [field for field in df.schema.fields if field.name not in names]
    schema = StructType(kept + new.fields)
    given = df.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(new)
        for batch in batches:
            values = [column.to_pylist() for column in batch.columns]
            found = [fn(dict(zip(given, row))) for row in zip(*values)]
            columns = [batch.column(given.index(field.name)) for field in kept]
            columns += [pa.array([one.get(name) for one in found], kinds.field(name).type) for name in names]
            yield pa.record_batch(columns, [*(field.name for field in kept), *names])

    return df.mapInArrow(run, schema)


def tokenize_with(
    df: DataFrame,
    load: Callable[[], Callable[[list[str]], list[list[int]]]],
    text: str = "text",
    max_length: int | None = MAX_LENGTH,
) -> DataFrame:
    """Adds `input_ids`, `attention_mask` and `n_tokens` by a tokenizer that `load` returns.

    The tokenizer is loaded once per task; it takes a list of texts and returns a list of id lists, of
    which `max_length` ids are kept. A NULL text is an empty one.
    """

    def encode(batches):
        import pandas as pd

        tokenizer = load()
        for texts in batches:
            ids = tokenizer(texts.tolist())
            yield pd.Series([list(row[:max_length]) for row in ids], index=texts.index)

    encode.__annotations__ = _series_iterator()
    ids = F.pandas_udf(encode, "array<int>")(F.coalesce(F.col(text), F.lit("")))
    return (
        df.withColumn("input_ids", ids)
        .withColumn("attention_mask", attention_mask(F.col("input_ids")))
        .withColumn("n_tokens", F.size("input_ids"))
    )


def _series_iterator() -> dict:
    import pandas as pd

    return {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}


def collate_batches(df: DataFrame, fn: Callable, schema: str, batch: str = "batch_id") -> DataFrame:
    """`fn` on the rows of each batch, as one pandas frame in slot order.

    A batch is a few rows. Many batches therefore go to Python in one transfer and are taken
    apart there; one that is cut by the end of a transfer waits for its other rows.

    A table that is kept by batch (`sinks.read_clustered`) is read as it lies; any other is dealt out by batch first.
    """

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        waiting = None
        for frame in frames:
            if waiting is not None:
                frame = pd.concat([waiting, frame], ignore_index=True)
            if not len(frame):
                continue
            last = frame[batch] == frame[batch].iloc[-1]
            waiting = frame[last]
            if not last.all():
                groups = frame[~last].groupby(batch, sort=False)
                yield pd.concat([fn(rows.copy()) for _, rows in groups], ignore_index=True)
        if waiting is not None:
            yield fn(waiting.copy())

    # The window asks for whole batches in slot order, and for a shuffle only where they don't lie so already.
    # Nothing in its condition is false; it is there so that the window is not left out.
    in_batch = Window.partitionBy(batch).orderBy("slot")
    whole = df.withColumn("_nth", F.row_number().over(in_batch)).where("_nth > 0").drop("_nth")
    return whole.mapInPandas(run, schema)


def packed_rows(batch, capacity: int | None = None, pad_id: int = 0):
    """A collate function: the rows of a batch packed into as few padded ones as first fit finds.

    In slot order a row joins the first pack that has room for it, of `capacity` ids or of the longest row's; a longer one
    is a pack of its own. `segments` numbers the rows inside a pack, -1 is padding.
    """
    import pandas as pd

    longest = max(map(len, batch["input_ids"]))
    room = longest if capacity is None else capacity
    packs: list[list] = []
    for ids in batch["input_ids"]:
        fits = (pack for pack in packs if sum(map(len, pack)) + len(ids) <= room)
        pack = next(fits, None)
        if pack is None:
            packs.append(pack := [])
        pack.append(ids)
    width = max(room, longest)
    rows = []
    for number, pack in enumerate(packs):
        ids = [i for row in pack for i in row]
        segments = [n for n, row in enumerate(pack) for _ in row]
        fill = width - len(ids)
        rows.append((batch["batch_id"].iloc[0], number, ids + [pad_id] * fill, segments + [-1] * fill))
    return pd.DataFrame(rows, columns=["batch_id", "pack", "input_ids", "segments"])


def map_step_ranges(df: DataFrame, fn: Callable, schema: str, steps: int = 4096) -> DataFrame:
    """`fn` on the rows of each rank and stretch of `steps` steps, as one pandas frame in step order.

    A stretch is a bounded number of batches, so ranks are worked on in as many tasks as they have
    stretches. What belongs to a whole rank is put together afterwards by an aggregation.
    """

    def run(frame):
        return fn(frame.sort_values(["step", "slot"]).reset_index(drop=True))

    stretch = whole_div(F.col("step"), steps)
    return df.groupBy("rank", stretch.alias("_stretch")).applyInPandas(run, schema)
