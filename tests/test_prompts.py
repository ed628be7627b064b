import pytest

from tunemill.operators.columns import drop_columns, keep_model_columns
from tunemill.operators.prompts import prompt_template

SCHEMA = "id bigint, instruction string, context string, response string"

WITHOUT_INPUT = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n"
    "    \n"
    "    ### Instruction:\n"
    "    Say hi\n"
    "    \n"
    "    ### Response:\n"
    "    hi\n"
    "    \n"
    "    ### End"
)
WITH_INPUT = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n"
    "    \n"
    "    ### Instruction:\n"
    "    Say hi\n"
    "    \n"
    "    Input:\n"
    "    {context}\n"
    "    \n"
    "    ### Response:\n"
    "    hi\n"
    "    \n"
    "    ### End"
)


@pytest.mark.parametrize(
    ("context", "expected"),
    [
        (None, WITHOUT_INPUT),
        ("", WITHOUT_INPUT),
        (" ", WITH_INPUT.replace("{context}", " ")),
        ("x", WITH_INPUT.replace("{context}", "x")),
        ("a\nb", WITH_INPUT.replace("{context}", "a\nb")),
        ("{instruction} %s {}", WITH_INPUT.replace("{context}", "{instruction} %s {}")),
    ],
)
def test_layout_follows_context(spark, context, expected):
    df = spark.createDataFrame([(1, "Say hi", context, "hi")], SCHEMA)
    assert prompt_template(df).first()["text"] == expected


def test_missing_values_are_written_as_none(spark):
    df = spark.createDataFrame([(1, None, None, None)], SCHEMA)
    text = prompt_template(df).first()["text"]
    assert "### Instruction:\n    None\n" in text
    assert "### Response:\n    None\n" in text


def test_context_column_may_be_absent_and_text_is_replaced(spark):
    df = spark.createDataFrame(
        [(1, "Say hi", "hi", "old")], "id bigint, instruction string, response string, text string"
    )
    assert prompt_template(df).first()["text"] == WITHOUT_INPUT


def test_drop_columns_is_strict(spark):
    df = spark.createDataFrame([(1, "a", None, "b")], SCHEMA)
    assert drop_columns(df, ["context", "response"]).columns == ["id", "instruction"]
    with pytest.raises(ValueError, match="category"):
        drop_columns(df)


def test_keep_model_columns(spark):
    df = spark.sql("SELECT 'x' AS text, 1L AS id, array(1) AS input_ids, array(1Y) AS attention_mask")
    assert keep_model_columns(df).columns == ["id", "input_ids", "attention_mask"]
