"""Duplicate and contamination operators against brute force on small tables."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tunemill.llm import common, components, decontamination, golay, line_dedup, recompression, simhash_dedup, substring_dedup

BLANK = "[\x20\x09-\x0d]+"


def spaced(text):
    return [w for w in re.split(BLANK, text or "") if w]


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


@pytest.fixture(scope="module")
def texts():
    """Random prose with copies, edited copies, shared passages and repeated words."""
    draw = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "Or", "ess", "ième")] + ["the", "of", "a"] * 3
    passage = [draw.choice(vocabulary) + str(draw.randrange(90)) for _ in range(75)]
    out = []
    for k in range(90):
        words = [draw.choice(vocabulary) + str(draw.randrange(60)) * draw.randrange(2) for _ in range(draw.choice([0, 3, 40, 120, 260]))]
        if k % 3 == 0:
            at = draw.randrange(len(words) + 1)
            words[at:at] = passage[draw.randrange(25) :]
        if k % 7 == 0:
            words[10:10] = ["same"] * draw.randrange(40, 90)
        if k % 4 == 1 and out:
            words = spaced(draw.choice(out))
            for _ in range(draw.randrange(3)):
                if words:
                    words[draw.randrange(len(words))] = "edited"
        out.append(re.sub("@", "\n", " ".join(w + ("@" if draw.random() < 0.08 else "") for w in words)))
    return [*out, "", None, "  \n "]


@pytest.fixture(scope="module")
def docs(spark, texts):
    order = random.Random(5).sample(range(len(texts)), len(texts))
    return spark.createDataFrame([(k, texts[k]) for k in order], "doc_id long, text string").repartition(5).cache()


def test_golay_lists_meet_for_one_error():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 4000, dtype=np.uint32)
    lists = golay.near_code_words(words)
    for bit in range(23):
        other = golay.near_code_words(words ^ np.uint32(1 << bit))
        assert (lists[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


def fingerprint(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in spaced(text)]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("paired", [64, 1])
def test_simhash_against_all_pairs(docs, texts, monkeypatch, paired):
    monkeypatch.setattr(simhash_dedup, "PAIRED", paired)
    prints = {k: fingerprint(t) for k, t in enumerate(texts)}
    expected = reachable(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = simhash_dedup.simhash_components(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        k: (f"{prints[k]:016x}", expected[k]) for k in prints
    }


@pytest.mark.parametrize("paired", [64, 2])
def test_fingerprint_links_lose_no_component(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash_dedup, "PAIRED", paired)
    draw = random.Random(2)
    prints = {}
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(25):
            prints.setdefault(at, len(prints))
            at ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 2, 3])))
    nodes = spark.createDataFrame([(p - (1 << 64) * (p >> 63), k) for p, k in prints.items()], "fp long, node long")
    by_node = {k: p for p, k in prints.items()}
    expected = reachable(by_node, lambda a, b: (by_node[a] ^ by_node[b]).bit_count() <= 2)
    found = components.connected_components(simhash_dedup.links_between(nodes)).collect()
    assert dict.fromkeys(by_node) | {n: n for n in by_node} | {r["node"]: r["component"] for r in found} == expected


def test_components_of_a_long_chain(spark):
    order = random.Random(1).sample(range(300), 300)
    links = [(order[k], order[k + 1]) for k in range(299) if k != 149] + [(7, 7), (None, 3)]
    found = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    low = {**dict.fromkeys(order[:150], min(order[:150])), **dict.fromkeys(order[150:], min(order[150:]))}
    assert {r["node"]: r["component"] for r in found} == low


def matched_lines(texts):
    lines = [(k, n, frozenset(spaced(line))) for k, t in enumerate(texts) if t is not None for n, line in enumerate(t.split("\n"))]
    gone = {}
    for at, (k, n, words) in enumerate(lines):
        earlier = (other for _, _, other in lines[:at])
        if words and any(5 * len(words & other) >= 4 * len(words | other) for other in earlier):
            gone.setdefault(k, set()).add(n)
    return gone


@pytest.mark.parametrize("early", [True, False])
def test_lines_against_all_pairs(docs, texts, monkeypatch, early):
    if not early:
        nothing = docs.sparkSession.createDataFrame([], "x long, y long")
        monkeypatch.setattr(line_dedup, "first_partners", lambda sets: nothing)
    gone = matched_lines(texts)
    for row in line_dedup.line_dedup(docs).collect():
        text = texts[row["doc_id"]]
        lines = [] if text is None else text.split("\n")
        drop = gone.get(row["doc_id"], set())
        assert (row["n_lines"], row["n_removed"]) == (len(lines), len(drop))
        assert row["kept_text"] == (None if text is None else "\n".join(x for n, x in enumerate(lines) if n not in drop))


def test_line_ids_beyond_64_bits(spark):
    docs = spark.createDataFrame([(2**62, "a b c d e"), (-(2**62), "a b c d e\nf g h i j"), (5, "f g h i j")], "doc_id long, text string")
    found = {r["doc_id"]: r["kept_text"] for r in line_dedup.line_dedup(docs).collect()}
    assert found == {2**62: "", -(2**62): "a b c d e\nf g h i j", 5: ""}


def test_lines_use_no_python(docs):
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "MapInArrow", "Pandas"))


def covered_words(texts, window=50):
    first = {}
    for k, text in enumerate(texts):
        words = spaced(text)
        for at in range(len(words) - window + 1):
            first.setdefault(tuple(words[at : at + window]), k)
    out = {}
    for k, text in enumerate(texts):
        words = spaced(text)
        cover = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < k:
                cover[at : at + window] = [True] * window
        kept = " ".join(w for w, c in zip(words, cover) if not c)
        out[k] = (len(words), sum(cover), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("bucket_bytes", [32_000_000, 5_000])
def test_substrings_against_all_windows(docs, texts, bucket_bytes):
    rows = substring_dedup.substring_dedup(docs, bucket_bytes, with_text=True).collect()
    expected = covered_words(texts)
    assert sum(e[1] for e in expected.values()) > 500
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected


def test_contexts_decide_symbols():
    draw = np.random.default_rng(4)
    shared = draw.integers(1, 9, 60).astype(np.uint64)
    found = []
    for _ in range(2):
        before, after = (draw.integers(1, 9, draw.integers(1, 30)).astype(np.uint64) for _ in range(2))
        names = recompression.mixed(np.concatenate([before, shared, after])) | np.uint64(1)
        end = np.array([recompression.END])
        symbols, low, high = recompression.recompress(np.concatenate([end, names, end]))
        at = len(before) + 1
        inside = (low >= at) & (high < at + 60)
        found.append(set(zip(symbols[inside].tolist(), (low[inside] - at).tolist())))
    assert found[0] == found[1] and found[0]


def occurrences(texts, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for at in range(max(len(words) - window, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + window]), set()).add(str(item))
    out = {}
    for k, text in enumerate(texts):
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                if names := windows.get(tuple(words[at : at + size])):
                    hit.update(range(at, at + size))
                    found |= names
        out[k] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("part_words", [50_000, 10])
def test_contamination_against_all_places(spark, docs, texts, part_words):
    draw = random.Random(9)
    items = [(12, "The of, A!"), (3, "?"), (100, "SAME same same")]
    for item in range(20, 30):
        words = spaced(draw.choice([t for t in texts if t and len(t) > 300]))
        at = draw.randrange(len(words) - 14)
        items.append((item, "; ".join(words[at : at + 14]).upper().replace("IÈME", "ième")))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(docs, benchmark, part_words=part_words)
    rows = decontamination.contamination_digest(found).collect()
    expected = occurrences(texts, items)
    assert sum(e[4] for e in expected.values()) > 5
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected


def test_proximity_matches(spark):
    docs = spark.createDataFrame(
        [(1, "x alpha y beta z gamma"), (2, "gamma beta alpha"), (3, "alpha beta"), (4, "alpha " + "x " * 9 + "beta gamma"), (5, "gamma"), (6, "alpha beta gamma")],
        "doc_id long, text string",
    ).coalesce(1)
    benchmark = spark.createDataFrame([(8, "alpha beta gamma")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontamination.find_contamination(docs, benchmark, slop=2).collect()}
    assert [k for k in rows if rows[k]["near"]] == [1, 2, 6]
    assert [k for k in rows if rows[k]["items"]] == [6]
    assert rows[6]["spans"][0].asDict() == {"start": 0, "end": 3}


def test_words_that_share_half_a_hash_are_different_words(spark):
    # These two agree in the low 32 bits of their XXH64, and each occurs once.
    docs = spark.createDataFrame([(1, "w43449"), (2, "w179392"), (3, "w43449 w179392 a b c"), (4, "w43449 a b c d")], "doc_id long, text string")
    rows = {r["doc_id"]: r["n_removed"] for r in line_dedup.line_dedup(docs).collect()}
    assert rows == {1: 0, 2: 0, 3: 0, 4: 0}


def test_a_set_has_two_names(spark):
    docs = spark.createDataFrame([(1, "b a a\nc"), (2, "a b")], "doc_id long, text string")
    slots = line_dedup.stored(line_dedup.slot_counts(docs), "slots")
    bits, kind = line_dedup.line_keys(docs)
    sets = line_dedup.described(line_dedup.token_sets(docs, slots, bits, kind)).collect()
    named = {tuple(r[c] for c in line_dedup.IDENTITY) for r in sets}
    assert len(sets) == 3 and len(named) == 2 and len({r["name"] for r in sets}) == 2
    assert sorted(r["n"] for r in sets) == [1, 2, 2]


def test_slot_counts_are_not_copied_into_rows(spark):
    docs = spark.createDataFrame([(1, "b a a\nc")], "doc_id long, text string")
    slots = line_dedup.stored(line_dedup.slot_counts(docs), "slots")
    plan = line_dedup.described(line_dedup.token_sets(docs, slots, *line_dedup.line_keys(docs)))._jdf.queryExecution()
    assert "AS _slots" not in plan.optimizedPlan().toString()


def test_listed_tokens_are_dealt_out_once(spark):
    """Both sides of the join of listed tokens read one shuffle."""
    line = "{} {} three four five six seven eight nine ten eleven twelve"
    rows = [(k, "\n".join(line.format(f"a{k}", f"b{j}") for j in range(3))) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bits, kind = line_dedup.line_keys(docs)
    slots = line_dedup.stored(line_dedup.slot_counts(docs), "slots")
    lines = line_dedup.described(line_dedup.token_sets(docs, slots, bits, kind)).withColumn("open", F.expr("key % 2 = 0"))
    entries = line_dedup.stored(line_dedup.listed(lines), "entries")
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = line_dedup.all_partners(entries)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "ReusedExchange" in plan
    pairs = {(r["x"], r["y"]) for r in line_dedup.all_partners(entries).collect()}
    assert pairs and all(x % 2 == 0 and y < x for x, y in pairs)


def test_slot_classes_lie_eight_in_a_long(spark):
    """Each slot's class is read back from its own byte."""
    docs = spark.createDataFrame([(1, " ".join("w%d" % k for k in range(50) for _ in range(1 + 40 * (k % 3))))], "doc_id long, text string")
    slots = line_dedup.stored(line_dedup.slot_counts(docs), "slots")
    assert slots.select(F.size("slots")).first()[0] == 1 << 17
    tokens = line_dedup.token_sets(docs, slots, *line_dedup.line_keys(docs)).first()["tokens"]
    steps = [token >> line_dedup.HASH_BITS for token in tokens]
    expected = sorted(int(8 * math.log2(2 + 40 * (k % 3))) for k in range(50))
    assert steps == expected


def test_bitmaps_have_the_bits_their_keys_need(spark):
    """Few keys give a small bitmap, which lets no key go missing; the size is bounded."""
    for count in (0, 5, 20_000):
        keys = line_dedup.stored(spark.range(count).select((F.col("id") * 3).alias("key")), "keys")
        bits = line_dedup.stored_bitmap(keys, "key")
        longs = bits.select(F.size("bits")).first()[0]
        assert max(64, count // 8) <= longs <= max(64, count // 3)
        inside = spark.range(3 * count + 300).withColumn("_bits", bits.scalar()).where(line_dedup.maybe_in(F.col("_bits"), F.col("id")))
        found = {r["id"] for r in inside.select("id").collect()}
        assert found >= set(range(0, 3 * count, 3)) and len(found) < count * 1.5 + 10
    assert line_dedup.bitmap(spark.range(1), "id", 10**9).select(F.size("bits")).first()[0] == 1 << 18


def test_shuffle_files_go_with_their_job(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {found.apply(k).getName() for k in range(found.length()) if found.apply(k).getName().startswith("shuffle_")}

    before, setting = files(), spark.conf.get(common.CLEANUP, None)
    line_dedup.stored(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    with common.shuffles_dropped(spark):
        assert spark.conf.get(common.CLEANUP) == "true"
    assert spark.conf.get(common.CLEANUP, None) == setting


def test_settled_lines_are_not_open(spark):
    """All but the lines that matched a first partner are open, whatever the bitmap lets through."""
    draw = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    lines = [" ".join(f"e{draw.randrange(10**6)}" if k in gone else w for k, w in enumerate(base)) for gone in (draw.sample(range(60), 3) for _ in range(400))]
    docs = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "doc_id long, text string")
    bits, kind = line_dedup.line_keys(docs)
    slots = line_dedup.stored(line_dedup.slot_counts(docs), "slots")
    sets = line_dedup.stored(line_dedup.described(line_dedup.token_sets(docs, slots, bits, kind)), "sets")
    early = line_dedup.matching(line_dedup.first_partners(sets), docs, bits, kind)
    open_lines = line_dedup.flagged(sets, early.select(F.col("x").alias("key")), line_dedup.stored_bitmap(early, "x")).where("open")
    assert {r["key"] for r in open_lines.collect()} == {r["key"] for r in sets.join(early, F.col("key") == F.col("x"), "left_anti").collect()}
    assert early.count() > 390
