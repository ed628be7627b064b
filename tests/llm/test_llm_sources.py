"""The divergence of sources against a plain version, with and without digests that clash."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tunemill.llm import source_divergence as divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, digest int, n double, value string"


def plain(rows, least=30, top=50):
    docs = [((lang or ""), (source or ""), terms(text or "")) for text, lang, source in rows]
    holding, groups = defaultdict(Counter), sorted({(lang, source) for lang, source, _ in docs})
    for lang, _, words in docs:
        holding[lang].update(set(words))
    kept = {lang: {t for t, n in found.items() if n >= least} for lang, found in holding.items()}
    counts = {group: Counter() for group in groups}
    for lang, source, words in docs:
        counts[lang, source].update(w for w in words if w in kept[lang])
    found = []
    for lang in {lang for lang, _ in groups}:
        v = len(kept[lang])
        sources = [s for other, s in groups if other == lang]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(count):
            total = sum(count.values())
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * v) for t in kept[lang]}

        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept[lang])) for o in sources if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept[lang] if counts[lang, s][t] and p[s][t] > q[t]]
            for part, entries, limit in (("pair", pairs, None), ("term", more, top)):
                ordered = sorted(entries, key=lambda e: (-e[1], e[0].encode()))[:limit]
                found += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(ordered)]
    return sorted(found)


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def table(spark, rows):
    return spark.createDataFrame([(n, *row, "a", 1, 0.5, "b") for n, row in enumerate(rows)], SCHEMA)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def random_docs(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "é", "Y", "zz")]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "de", None])
        # One source holds a third of all rows.
        source = rng.choice(["hot", "hot", "s1", "s2", None, "s3"])
        words = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randrange(0, 12))
        rows.append((rng.choice([" ", "-3", "\n"]).join(words), lang, source))
    return rows


@pytest.mark.parametrize("bits", [64, 3])
@pytest.mark.parametrize("cells", [1 << 21, 40])
def test_against_plain(spark, monkeypatch, bits, cells):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    rows = random_docs(1)
    assert result(divergence.source_divergence(table(spark, rows), least=10, top=5, bits=bits)) == plain(rows, 10, 5)


def test_a_clash_keeps_no_rare_term(spark):
    # With one bit nearly all terms clash: "rare" and "frequent" ones share a digest that is frequent.
    rows = [("common", "en", "a")] * 40 + [(f"rare{c}", "en", "b") for c in "abcdefghij"] + [("also common", "en", "b")] * 35
    found = result(divergence.source_divergence(table(spark, rows), bits=1))
    assert found == plain(rows) and {r[3] for r in found if r[2] == "term"} == {"also", "common"}


def test_odd_documents(spark):
    long_text = "Straße und Ärger " * 200_000
    rows = [
        (None, None, None), (None, None, None), ("", "en", "empty"), ("12 34 !?", "en", "numbers"), ("\x00A\x7fa", "en", "odd"),
        (long_text, "de", "long"), (long_text, "de", "long"), ("und", "de", "short"), ("日本語 🙂", "ja", "one"),
    ]
    assert result(divergence.source_divergence(table(spark, rows), least=2)) == plain(rows, 2)
    # No term is frequent enough: pairs still differ by nothing.
    found = result(divergence.source_divergence(table(spark, rows)))
    assert found == plain(rows) and {r[4] for r in found} == {0}


def test_ties_at_the_last_rank_go_by_name(spark):
    words = [f"w{c}" for c in "édcbaz"]
    rows = [(" ".join(words), "en", "a")] * 3 + [("other", "en", "b")] * 3
    found = result(divergence.source_divergence(table(spark, rows), least=3, top=2))
    assert found == plain(rows, 3, 2)
    assert [r[3] for r in found if r[2] == "term" and r[1] == "a"] == ["wa", "wb"]


def test_no_documents(spark):
    assert result(divergence.source_divergence(table(spark, []))) == []


def test_very_large_counts_stay_exact(spark):
    row = spark.range(1).select(divergence._share(divergence.F.lit(10**12), divergence.F.lit(10**13), divergence.F.lit(7)).alias("p"))
    assert row.first()["p"] == 1 + 10**9 * (10**12 + 5) // (10**13 + 35)
