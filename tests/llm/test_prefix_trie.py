"""The trie against nested dictionaries, long conversations in stretches, and odd tables."""

import hashlib
import math
import random
import zlib

import pytest

from layerforge.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, weight int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def lent(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    below = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        saved, leaves, kids = below.pop(node, (0, 0, 0))
        saved, leaves = saved + own, leaves or 1
        if node:
            up = below.get(node[:-1], (0, 0, 0))
            below[node[:-1]] = (up[0] + saved, up[1] + leaves, up[2] + 1)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def conversations(seed, n=150, texts=4, most=9):
    rng = random.Random(seed)
    ids = [rng.choice([k, 100 * (k % 5) + k, -k]) for k in range(n)]
    rows = []
    for c in dict.fromkeys(ids):
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "é" * rng.randrange(texts), 1, "x", 2))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_nested_dictionaries(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie.prefix_trie(df)) == nodes(ordered(rows))
    assert found(prefix_trie.trie(prefix_trie.rebuilt(df))) == nodes(lent(ordered(rows)))


def test_long_conversations_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    rows = conversations(7, n=30, texts=2, most=40)
    rows += [(1000 + k, 10**12 * t - 5 * 10**12, "user", "same", 1, "x", 2) for k in range(3) for t in range(11 + k)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie.trie(prefix_trie.rebuilt(df))) == nodes(lent(ordered(rows)))


def test_copies_share_everything(spark):
    rows = [(c, t, "user", "same words", 1, "x", 2) for c in range(200, 1200, 5) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(prefix_trie.prefix_trie(df))
    assert got == nodes(ordered(rows)) and len(got) == 4
    assert prefix_trie.sequences(prefix_trie.with_roots(prefix_trie.numbered(df))).count() == 1


def test_odd_tables(spark):
    rows = [
        (1, None, None, None, None, None, None),
        (1, 0, "user", "hello", 1, "x", 1),
        (1, 0, "user", "hello", 1, "x", 1),
        (2, 5, "", "", 1, "x", 1),
        (2, -3, None, "x" * 100_000, 1, "x", 1),
        (3, 0, "1:a", "b", 1, "x", 1),
        (4, 0, "1", ":ab", 1, "x", 1),
        (-7, 0, "user", "漢字", 1, "x", 1),
        (None, 0, "user", "nobody", 1, "x", 1),
        # So few own turns that nothing is left, and no conversation to lend.
        *[(c, 0, "user", "only", 1, "x", 1) for c in range(901, 912)],
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie.prefix_trie(df)) == nodes(ordered(rows))
    got = found(prefix_trie.trie(prefix_trie.rebuilt(df)))
    assert got == nodes(lent(ordered(rows)))
    assert any(not turns for turns in lent(ordered(rows)).values())
    assert found(prefix_trie.trie(prefix_trie.rebuilt(df.limit(0)))) == []
