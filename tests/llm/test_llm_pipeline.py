"""run() of the pipeline against a plain version of its five stages; the trained model is taken as given."""

import numpy as np
import sentencepiece

import corpus_pipeline
from test_llm_duplicates import matched_lines, occurrences
from test_llm_near import kept
from tunemill.llm import toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_rows_of_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    prose = [f"planted{k}" for k in range(120)]
    broken = ["\n".join(" ".join(words[at : at + step]) for at in range(0, 120, step)) for words, step in (
        (prose, 11), ([*prose[:60], "changed", *prose[61:]], 17), ([*prose[:40], "a", "b", "c", "d", *prose[80:]], 23),
    )]
    passage = benchmark.select("text").first()[0]
    planted = [(10_000 + k, text, "en", "src1", 1) for k, text in enumerate([*broken, f"Before. {passage} After."])]
    spark.createDataFrame(planted, docs.schema).union(docs).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    all_docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train_toxicity(all_docs, labels)
    rows = sorted((r["doc_id"], r["text"]) for r in all_docs.collect())
    rows = [(k, t) for k, t in rows if model.bias + float(model.weights[toxicity.featurize((t or "").encode())].sum()) < 0]
    gone = matched_lines([t for _, t in rows])
    rows = [
        (k, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(at, ())))
        for at, (k, t) in enumerate(rows)
    ]
    stay = kept(rows)
    assert 10_000 in stay and 10_001 not in stay and 10_002 in stay
    rows = [(k, t) for k, t in rows if k in stay]
    found = occurrences([t for _, t in rows], [(r["item_id"], r["text"]) for r in benchmark.collect()])
    rows = [row for at, row in enumerate(rows) if not found[at][4]]
    pieces = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    expected = {k: (t, None if t is None else pieces.encode(t)) for k, t in rows}

    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(result) == len(expected) and 10_003 not in expected
    assert {r["doc_id"]: (r["text"], None if r["ids"] is None else np.array(r["ids"]).tolist()) for r in result} == expected
