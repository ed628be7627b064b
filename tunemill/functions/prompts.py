"""Prompt text as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published Alpaca-style wording and the exact line layout.
# Every line after the first is indented by four spaces, empty lines included.
INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
INSTRUCTION_HEADING = "### Instruction:"
INPUT_HEADING = "Input:"
RESPONSE_HEADING = "### Response:"
END_MARK = "### End"
LINE_BREAK = "\n    "


def _shown(value: Column) -> Column:
    # A missing value is written out as the word None.
    return F.coalesce(value, F.lit("None"))


def prompt_text(instruction: Column, context: Column, response: Column) -> Column:
    """The full prompt. A NULL or empty context selects the layout without input.

    A blank context counts as present. Values are only ever concatenated, so braces or
    percent signs in the data stay as they are.
    """
    blank = F.lit("")
    head = [F.lit(INTRO), blank, F.lit(INSTRUCTION_HEADING), _shown(instruction), blank]
    given = [F.lit(INPUT_HEADING), context, blank]
    tail = [F.lit(RESPONSE_HEADING), _shown(response), blank, F.lit(END_MARK)]
    return F.when(context != "", F.concat_ws(LINE_BREAK, *head, *given, *tail)).otherwise(
        F.concat_ws(LINE_BREAK, *head, *tail)
    )
