"""Running totals and row positions that no single task has to hold.

A window over all rows of a key runs in one task. Here the order is cut into blocks: totals
per block are small, their running total is taken first, and the rows only need a window
inside their block. The result is the same, and a key with a third of all rows is spread
like any other.

Positions over a whole table (`with_cut_position`, `with_shuffled_position`) cut the order into
`RANGES` ranges of nearly equal numbers of rows, whatever the ids look like. Where a range begins travels as one value of
RANGES numbers, so rows are dealt out once and joined with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.functions.integers import whole_div

# A block of ids spans 2**16 ids, so at most that many rows as ids are unique. A block of
# bucket sizes spans 2**24 buckets; two such levels cover every BIGINT.
ID_BITS = 16
BLOCK_BITS = 24
# Ranges of a whole table: 12 bits of a shuffle key, or as many cuts between ids, found in two steps.
RANGE_BITS = 12
RANGES, CUTS_PER_STEP = 1 << RANGE_BITS, 64


def _present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df`, in which a NULL in one of `columns` is an error."""
    kinds = {field.name: field.dataType for field in df.schema}
    checked = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in {c.strip('_')}, which has to order or group rows")).cast(kinds[c]))
        for c in columns
    }
    # The joins below ask for values. Asked for here, both sides of a join begin with the same
    # plan, and Spark runs it once.
    present = [F.col(c).isNotNull() for c in columns]
    return df.withColumns(checked).where(reduce(and_, present))


def running_total_before(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    name: str,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows of the same keys with a smaller `at`.

    `(keys, at)` is unique and not NULL, `at` is a BIGINT.
    """
    keys = list(keys)
    blocked = _present(
        df.withColumn("_block", F.shiftright(F.col(at), bits)), [*keys, at, "_block"]
    )
    earlier = (Window.unboundedPreceding, -1)
    block_start = (
        blocked.groupBy(*keys, "_block")
        .agg(F.sum(value).alias("_block_total"))
        .withColumn(
            "_block_start",
            F.sum("_block_total").over(
                Window.partitionBy(*keys).orderBy("_block").rowsBetween(*earlier)
            ),
        )
        .drop("_block_total")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(at).rowsBetween(*earlier)
    zero = F.lit(0)
    return (
        blocked.withColumn("_inside", F.sum(value).over(inside))
        .join(block_start, [*keys, "_block"])
        .withColumn(name, F.coalesce("_inside", zero) + F.coalesce("_block_start", zero))
        .drop("_block", "_inside", "_block_start")
    )


def with_position(
    df: DataFrame,
    order: Sequence[str],
    bucket: Column,
    keys: Sequence[str] = (),
    name: str = "position",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Adds `name`: the row's number from 1 in `order`, within the same keys.

    `bucket` is a BIGINT that never falls along `order` and that few rows share. Keys and
    bucket are not NULL.
    """
    keys = list(keys)
    bucketed = _present(df.withColumn("_bucket", bucket), [*keys, "_bucket"])
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    starts = running_total_before(sizes, keys, "_bucket", "_rows", "_before", bits).drop("_rows")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        bucketed.join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_before") + F.row_number().over(inside))
        .drop("_bucket", "_before")
    )


def with_id_position(
    df: DataFrame,
    id_column: str = "id",
    keys: Sequence[str] = (),
    name: str = "position",
    id_bits: int = ID_BITS,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """`with_position` in the order of a unique BIGINT id."""
    bucket = F.shiftright(F.col(id_column), id_bits)
    return with_position(df, [id_column], bucket, keys, name, bits)


def _range_by_cuts(df: DataFrame, column: str) -> DataFrame:
    """Adds `_range`: how many of the cut points the BIGINT `column` reaches.

    The cut points come from a quantile sketch of all rows, so ranges hold nearly equal numbers of them. They
    travel as one value, as lists of CUTS_PER_STEP, and a row is compared with the heads of the lists and with one list.
    """
    shares = F.lit([i / RANGES for i in range(1, RANGES)])
    firsts = F.lit(list(range(0, RANGES - 1, CUTS_PER_STEP)))
    sketch = F.array(F.coalesce(F.percentile_approx(column, shares, 10 * RANGES), F.array().cast("array<bigint>")))
    lists = F.transform(sketch, lambda c: F.transform(firsts, lambda i: F.slice(c, i + 1, CUTS_PER_STEP)))[0]
    # One struct, so that a look into both parts of it is one use of the value.
    heads = df.agg(lists.alias("lists")).select(
        F.struct(F.transform("lists", lambda one: F.get(one, F.lit(0))).alias("heads"), "lists").alias("cuts")
    )

    def reached(points: Column) -> Column:
        return F.size(F.filter(points, lambda point: point <= F.col(column)))

    def place(cuts: Column) -> Column:
        step = reached(cuts["heads"])
        inside = reached(F.coalesce(F.get(cuts["lists"], step - 1), F.array().cast("array<bigint>")))
        return F.greatest(step - 1, F.lit(0)) * CUTS_PER_STEP + inside

    # One select after the subquery column, so that the two merge and the value isn't copied into each row.
    return df.withColumn("_cuts", heads.scalar()).select(
        *df.columns, F.transform(F.array("_cuts"), place)[0].cast("bigint").alias("_range")
    )


def _range_totals(ranged: DataFrame, ranges: int) -> Column:
    """One value: `before`, the rows in the ranges before each one, and `rows`, their number in all."""
    spark = ranged.sparkSession
    # Every range has a row, so that the n-th entry is the n-th range.
    each = ranged.select("_range", F.lit(1).cast("bigint").alias("n"))
    every = spark.range(ranges).select(F.col("id").alias("_range"), F.lit(0).cast("bigint").alias("n"))
    sizes = each.union(every).groupBy("_range").agg(F.sum("n").alias("n"))
    # A row per range goes through this window.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))
    listed = F.sort_array(F.collect_list(F.struct("_range", "before")))
    return placed.agg(F.struct(F.transform(listed, lambda r: r["before"]).alias("before"), F.sum("n").alias("rows"))).scalar()


def _numbered(ranged: DataFrame, ranges: int, order: Sequence[str], name: str) -> DataFrame:
    """Adds `name`, the row's number from 1 by range and by `order` inside it, and `_rows`, the number of all rows."""
    inside = Window.partitionBy("_range").orderBy(*order)
    columns = [F.col(c) for c in ranged.columns if c not in (name, "_range")]

    def placed(totals: Column) -> Column:
        before = F.get(totals["before"], F.col("_range").cast("int"))
        return F.struct((before + F.col("_inside")).alias("at"), totals["rows"].alias("rows"))

    numbered = ranged.withColumn("_inside", F.row_number().over(inside)).withColumn("_totals", _range_totals(ranged, ranges))
    return numbered.select(*columns, F.transform(F.array("_totals"), placed)[0].alias("_placed")).select(
        *columns, F.col("_placed.at").alias(name), F.col("_placed.rows").alias("_rows")
    )


def with_cut_position(df: DataFrame, id_column: str = "id", name: str = "position") -> DataFrame:
    """Adds `name`, the row's number from 1 in the order of a unique BIGINT id, and `_rows`, the number of all rows.

    A NULL id is an error.
    """
    present = _present(df, [id_column])
    return _numbered(_range_by_cuts(present, id_column), RANGES, [id_column], name)


def with_shuffled_position(
    df: DataFrame, seed: int | str, id_column: str = "id", name: str = "position", epochs: int | None = None
) -> DataFrame:
    """Adds `name`, the row's number from 1 in a random-looking order that depends on seed and id alone, and `_rows`.

    The order is that of an MD5, whose first bits are the range: ids are unique, so ranges are equal by themselves.
    With `epochs` every row is there once per epoch (column `epoch`), each epoch in an order of its own, numbered
    apart; `_rows` is then the number of rows of one epoch.
    """
    once = _present(df, [id_column])
    prefix: Column | str = F.lit(f"{seed}:")
    if epochs is not None:
        once = once.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        prefix = F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"), F.lit(":"))
    keyed = once.withColumn("_shuffle", F.md5(F.concat(prefix, F.col(id_column).cast("string"))))
    first = F.shiftright(F.conv(F.substring("_shuffle", 1, 4), 16, 10).cast("bigint"), 16 - RANGE_BITS)
    if epochs is None:
        return _numbered(keyed.withColumn("_range", first), RANGES, ["_shuffle", id_column], name).drop("_shuffle")
    # Ranges of an epoch follow those of the epoch before.
    ranged = keyed.withColumn("_range", F.col("epoch") * RANGES + first)
    numbered = _numbered(ranged, RANGES * epochs, ["_shuffle", id_column], name).drop("_shuffle")
    rows = whole_div(F.col("_rows"), epochs)
    return numbered.withColumns({name: F.col(name) - F.col("epoch") * rows, "_rows": rows})
