"""Instruction rows to prompt rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.functions.prompts import prompt_text


def prompt_template(df: DataFrame) -> DataFrame:
    """Adds `text`, replacing one that is there; `context` may be absent."""
    context = F.col("context") if "context" in df.columns else F.lit(None).cast("string")
    return df.withColumn("text", prompt_text(F.col("instruction"), context, F.col("response")))
