"""Instruction tables and cached tables."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.sources.tables import file_system_path

# The row id is required: the order of a table is the order of its ids.
REQUIRED = {"id": "bigint", "instruction": "string", "response": "string"}
OPTIONAL = {"context": "string", "category": "string"}


def conform_instructions(df: DataFrame) -> DataFrame:
    """The instruction columns with their types; absent optional ones become NULL."""
    absent = [c for c in REQUIRED if c not in df.columns]
    if absent:
        raise ValueError(f"not an instruction table, columns are missing: {absent}")
    typed = [
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        for c, t in {**REQUIRED, **OPTIONAL}.items()
    ]
    others = [F.col(c) for c in df.columns if c not in REQUIRED and c not in OPTIONAL]
    return df.select(*typed, *others)


def load_instructions(
    spark: SparkSession,
    path: str,
    split: str | None = None,
    file_format: str = "parquet",
    schema: str | None = None,
    **options,
) -> DataFrame:
    """An instruction table from parquet, JSON or CSV files, one split of it on request.

    `split` may be a column or a `split=...` directory level; as a directory only its own
    files are read.
    """
    reader = spark.read.format(file_format).options(**options)
    if schema:
        reader = reader.schema(schema)
    rows = conform_instructions(reader.load(path))
    return rows if split is None else split_filter(rows, split)


def split_filter(df: DataFrame, split: str = "train") -> DataFrame:
    if "split" not in df.columns:
        raise ValueError("the table has no split column")
    return df.where(F.col("split") == split)


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table written at `path`, built and written first if it is not complete there.

    A folder without the mark of a finished write is not touched: that is an error.
    """
    files, done = file_system_path(spark, f"{path}/_SUCCESS")
    if not files.exists(done):
        build().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def content_cached(df: DataFrame, folder: str) -> DataFrame:
    """`df` as written under `folder` for the files it comes from as they are now, built and written first if it isn't there.

    The build's folder is named by a digest of the names, lengths and times of the files that `df` reads, and of its plan, so
    changed files or another plan give a build of their own; older ones stay until they are removed.
    A build is written aside and renamed, so what has its name is complete; of two writers at a time, one's is kept.
    Tables that don't come from files have no such digest: that is an error.
    """
    spark = df.sparkSession
    target = f"{folder.rstrip('/')}/{_content_key(df)}"
    files, done = file_system_path(spark, target)
    if not files.exists(done):
        aside = f".writing-{uuid.uuid4().hex}"
        written = file_system_path(spark, f"{folder.rstrip('/')}/{aside}")[1]
        df.write.parquet(f"{folder.rstrip('/')}/{aside}")
        if files.exists(done) or not files.rename(written, done):
            files.delete(written, True)
        # A rename onto a folder that has just come to be puts the second build inside it.
        files.delete(file_system_path(spark, f"{target}/{aside}")[1], True)
    return spark.read.parquet(target)


def _content_key(df: DataFrame) -> str:
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    kinds = {leaves.apply(i).nodeName().split()[0] for i in range(leaves.size())}
    if not kinds <= {"LogicalRelation", "Relation", "Range", "OneRowRelation"}:
        raise ValueError(f"only tables read from files have a content key, not {sorted(kinds)}")
    # Numbers of columns and of lambda variables differ from one session to another; their order doesn't.
    seen: dict[str, str] = {}
    text = re.sub(r"#\d+|\bx_\d+", lambda m: seen.setdefault(m.group(), f"#{len(seen)}"), _whole_text(spark, plan))
    paths = df.inputFiles()
    state = ""
    if paths:
        # Sums don't depend on the order of the files, which are as many rows as there are files.
        listed = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
        first, second = F.xxhash64(*listed.columns), F.xxhash64(F.lit("second"), *listed.columns)
        state = listed.agg(F.count(F.lit(1)), *[F.sum(h.cast("decimal(38,0)")) for h in (first, second)]).first()
    return hashlib.sha256(f"{text}\n{state}".encode()).hexdigest()


def _whole_text(spark: SparkSession, plan) -> str:
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, str(2**31 - 1))
    try:
        return plan.toString()
    finally:
        spark.conf.set(name, before)
