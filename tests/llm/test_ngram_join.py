import random

import pytest
from llm_cases import empty, frame, odd, prose, rows

from layerforge.llm import ngram_join
from layerforge.llm.components import components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute(texts, width, percent):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((k, len(sets[k]), find(k)) for k in sets)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_links_like_brute_force(spark, width, percent):
    rng = random.Random(5)
    texts = {}
    for group in range(6):
        base = prose(group, rng.choice([40, 150, 400])).split(" ")
        for _ in range(rng.choice([1, 4, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(copy)
    passage = prose(99, 60)
    for k in range(30):  # a passage that many documents share
        texts[len(texts)] = passage + " " + prose(1000 + k, rng.choice([3, 30, 200]))
    docs = frame(spark, list(texts.values()))
    got = rows(ngram_join.linked_documents(docs, width, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute(texts, width, percent), key=repr)


def test_frequent_buckets_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 4)
    base = prose(3, 120).split(" ")
    texts = {}
    for k in range(40):
        copy = list(base)
        for j in range(k % 5):
            copy[(7 * k + 13 * j) % len(copy)] = f"x{k}y{j}"
        texts[k] = " ".join(copy)
    got = rows(ngram_join.linked_documents(frame(spark, list(texts.values())), 3, 90), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute(texts, 3, 90), key=repr)


def test_odd_rows(spark):
    got = rows(ngram_join.linked_documents(odd(spark), 3, 90), "doc_id", "n_shingles", "component_id")
    assert len(got) == 10
    by = {}
    for doc, n, component in got:
        by.setdefault(doc, []).append((n, component))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[5] == [(1, 5)]
    assert [c for _, c in by[6] + by[7]] == [6, 6, 6]
    assert by[None][0][1] is None
    assert ngram_join.linked_documents(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = ngram_join.first_of_each(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, 5, 6, 8, None], key=repr)


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 40)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = dict(rows(components(df), "node", "root"))
    assert got == {**{k: 0 for k in range(1, 51)}, **{100 + k: 100 for k in range(1, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
