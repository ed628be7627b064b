"""Registered queries: against SQL where there is some, on cases that tables hold now and then, and without the package."""

import hashlib
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tunemill.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    license_scan,
    line_dedup,
    quality,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
    toxicity,
)
from tunemill.llm.oracles import ORACLES
from tunemill.llm.queries import PIECE_MODEL, QUERIES

REPO = Path(__file__).resolve().parents[2]
SF_DIR = "/root/testdata/sf0.001"
# Clashing names: columns that operators give out or use inside.
SCHEMA = "doc_id long, text string, score double, fp long, key string, ids array<int>, n_words string, flags binary, x int"


def odd_rows():
    long_text = " ".join(f"word{k % 700} filler" for k in range(30_000))
    rows = [
        (1, "the quick brown fox\njumps over the lazy dog"),
        (1, "the quick brown fox\njumps over the lazy dog"),
        (2, ""),
        (3, None),
        (None, "the quick brown fox\njumps over the lazy dog"),
        (None, None),
        (4, " \n\t\r\n "),
        (5, long_text),
        (6, long_text + " more"),
        (7, "under the MIT License; <|im_end|> ▁   日本語 🙂"),
    ]
    return [(i, t, None, None, None, None, None, None, None) for i, t in rows]


def operators(spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "quick brown fox"), (2, None), (None, "lazy dog"), (3, "?!")], "item_id long, text string")
    return {
        "simhash": simhash_dedup.simhash_components,
        "decontamination": lambda d: decontamination.find_contamination(d, benchmark, slop=2),
        "quality": lambda d: quality.score_quality(d, quality.train_quality(d, labels)),
        "sentencepiece": lambda d: sentencepiece_codec.encode(d, PIECE_MODEL, round_trip=True, parity=True),
        "line": line_dedup.line_dedup,
        "license": license_scan.license_scan,
        "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.train_toxicity(d, labels)),
        "exact": exact_dedup.exact_dedup,
        "substring": substring_dedup.substring_dedup,
        "keep_one": simhash_dedup.keep_one,
        "drop_lines": line_dedup.drop_lines,
        "drop_contaminated": lambda d: decontamination.drop_contaminated(d, benchmark),
        "drop_toxic": lambda d: toxicity.drop_toxic(d, labels),
    }


NAMES = [
    "simhash", "decontamination", "quality", "sentencepiece", "line", "license", "toxicity", "exact", "substring",
    "keep_one", "drop_lines", "drop_contaminated", "drop_toxic",
]
DROPPING = {"keep_one", "drop_contaminated", "drop_toxic"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    rows = operators(spark)[name](docs).collect()
    if name not in DROPPING:
        assert len(rows) == docs.count()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in odd_rows())


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["keep_one", "drop_lines", "drop_contaminated", "drop_toxic"])
def test_stages_keep_the_columns(spark, name):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert operators(spark)[name](docs).schema == docs.schema


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = database.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys() - {"op12_neighbour_search"}))
def test_query_covers_all_documents(spark, name):
    rows = QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()
    assert sorted(rows) == sorted(documents)


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(5, "a  b"), (3, "a b"), (3, "a b"), (None, "a\tb"), (9, None), (8, "")], "doc_id long, text string")
    rows = exact_dedup.exact_dedup(docs, salts=3).collect()
    kept = sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in rows if r["kept"])
    assert kept == [(3, 3, 4), (8, 8, 2)]
    assert {r["text_sha256"] for r in rows if r["doc_id"] == 5} == {hashlib.sha256(b"a b").hexdigest()}
    assert exact_dedup.keep_first(docs.where("doc_id > 3")).count() == 2


def test_the_rest_works_without_this_package(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[1:] == ["True", "False"] or "False False" in done.stdout


def test_chats_come_back_from_their_text(spark):
    said = [
        (1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
        (1, 1, "assistant", "<\\|im_end|> <\\\\| <| |> \\"),
        (1, 2, "assistant", None),
        (2, None, None, "x\n\ny"),
        (2, 0, "odd\nrole\\n<|im_end|>", "é🙂"),
        (None, 1, "assistant", ""),
        (3, 5, "assistant", "same"),
        (3, 5, "assistant", "same"),
    ]
    messages = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    digest = {r["conv_id"]: r for r in chat_format.chat_digest(messages.withColumn("parts", chat_format.text_parts())).collect()}
    for conv in {row[0] for row in said}:
        turns = [(r or "", t or "") for c, _, r, t in said if c == conv]
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        row = digest[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_attachments_are_numbered_and_counted(spark):
    parts = "array<struct<kind: string, text: string, uri: string, tokens: int>>"
    rows = [
        (1, 0, "user", [("image", None, "a.png", 10), ("text", "look <|", None, None), ("audio", None, "b.wav", None)]),
        (1, 1, "assistant", [("text", "I see", None, None), ("document", None, "c.pdf", 5), ("odd", "kept", None, None)]),
        (2, 0, "user", None),
    ]
    chats = chat_format.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}"))
    first, second = sorted(chats.collect(), key=lambda r: r["conv_id"])
    assert first["formatted"] == (
        "<|im_start|>user\n<|image:1|>look <\\|<|audio:2|><|im_end|>\n"
        "<|im_start|>assistant\nI see<|document:3|>kept<|im_end|>\n"
    )
    assert [(a["number"], a["kind"], a["uri"], a["tokens"]) for a in first["attachments"]] == [
        (1, "image", "a.png", 10), (2, "audio", "b.wav", 750), (3, "document", "c.pdf", 5),
    ]
    assert first["n_tokens_expanded"] == 765
    masked = [first["formatted"][t["start"] : t["end"]] for t in first["turns"] if t["loss"]]
    assert masked == ["I see<|document:3|>kept"]
    assert second["formatted"] == "<|im_start|>user\n<|im_end|>\n"


def test_chats_use_no_python(spark):
    messages = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat_format.chat_digest(messages.withColumn("parts", chat_format.text_parts()))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
