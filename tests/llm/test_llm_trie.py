"""The trie of conversations against a plain version, whatever the shards."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tunemill.llm import conversation_trie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, shard int, key binary"


def plain(rows, rebuild=True):
    """All nodes, from (conv_id, turn, role, text)."""
    said = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            said[conv_id].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [turn for *_, turn in sorted(turns)] for c, turns in said.items()}
    paths = {}
    for conv_id, turns in own.items():
        h = zlib.crc32(str(conv_id).encode()) % 4 if rebuild else 0
        first = conv_id - int(abs(conv_id) % 20 * (1 if conv_id >= 0 else -1))
        paths[conv_id] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for conv_id, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv_id)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += children[node] == 0
            saved[node[:depth]] += (len(held) - 1) * words
    found = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(paths[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        found.append(
            (min(held), len(node), above, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=repr)


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*row, None, None, None, None) for row in rows], SCHEMA)


def random_chats(seed, convs=300):
    rng = random.Random(seed)
    rows = []
    for conv_id in rng.sample(range(-100, 900), convs):
        # A third are copies of one chat; the others differ late, early or not at all.
        length = 6 if rng.random() < 0.33 else rng.randrange(1, 7)
        copy = length == 6
        for turn in range(length):
            text = f"said {turn} a b" if copy or rng.random() < 0.7 else f"other {rng.randrange(4)}"
            rows.append((conv_id, turn, "user" if turn % 2 else "assistant", text))
    return rows


@pytest.mark.parametrize("partitions", ["1", "5", "40"])
def test_trie_against_plain(spark, conf, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = random_chats(3)
    assert nodes(trie.conversation_trie(table(spark, rows))) == plain(rows)
    assert nodes(trie.conversation_trie(table(spark, rows), rebuild=False)) == plain(rows, rebuild=False)


def test_shards_really_share_nodes(spark, conf):
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shards = trie.sorted_shards(trie.own_turns(table(spark, random_chats(4))))
    edges = trie.splitter_trie(shards)
    assert len(edges) > 3 and max(left for left, _ in edges.values()) == 6
    kinds = Counter(r["kind"] for r in trie.shard_nodes(shards).select("kind").collect())
    assert kinds["part"] > 8 and kinds["ends"] > 1 and kinds["below"] and kinds["node"]


def test_pieces_of_a_list_are_hashed_in_order(spark, conf, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(c, 0, "user", "same") for c in range(1000)]
    assert nodes(trie.conversation_trie(table(spark, rows), rebuild=False)) == plain(rows, rebuild=False)


def test_odd_conversations(spark):
    long_text = "word " * 300_000
    rows = [
        (1, None, None, None),
        (1, 0, "user", ""),
        (1, 0, "user", "tie"),
        (1, 0, "user", "tie"),
        (None, 0, "user", "nobody's"),
        (20, 1, "user", long_text),
        (21, 1, "user", long_text),
        (41, 0, "user", "its family's first is absent"),
        (-3, 0, "a", "b:c"),
        (-4, 0, "a:", "bc"),
    ]
    assert nodes(trie.conversation_trie(table(spark, rows))) == plain(rows)
    # 2 takes three turns of an absent conversation and has none left of its own.
    turnless = [(c, 0, "user", "x") for c in range(1, 20)]
    found = nodes(trie.conversation_trie(table(spark, turnless)))
    assert found == plain(turnless) and found[0][4] < 19


def test_no_conversations(spark):
    assert nodes(trie.conversation_trie(table(spark, []))) == []
