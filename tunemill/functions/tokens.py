"""Token-level column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the default tokenizer: a token is a run of letters and digits or one
# other visible character; the first ids are reserved.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
FIRST_TOKEN_ID = 3
MAX_LENGTH = 512


def split_tokens(text: Column) -> Column:
    """Lower-cased tokens of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def attention_mask(ids: Column) -> Column:
    """One 1 for every id of an unpadded row."""
    return F.array_repeat(F.lit(1).cast("tinyint"), F.size(ids))
