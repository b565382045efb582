import random

import numpy as np
import pyarrow as pa
from llm_cases import empty, odd, prose
from pyspark.sql import functions as F

from layerforge.llm import quality_model, samples, toxicity


def labelled(spark, n=300):
    """Bad words make a document toxic, repeated words make it poor; some rows have no label."""
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(n):
        words = prose(k, rng.randint(20, 80)).split(" ")
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if not good:
            words = [w for w in words[:8] for _ in range(8)]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["zzgrim", "zzfoul", "zzvile"]))
        docs.append((k, " ".join(words), rng.choice(["en", "de", None]), 9.0, "clash"))
        labels.append((k, good, toxic if k % 7 else None, "extra"))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, score double, label string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    truth = {r["doc_id"]: r for r in labels.collect()}
    made = toxicity.scored(docs, toxicity.train(docs, labels))
    assert set(made.columns) == {*docs.columns, "held_out", "predicted", "flagged"}
    out = [r for r in made.collect() if r["held_out"] and truth[r["doc_id"]]["toxic"] is not None]
    assert len(out) > 30
    assert np.mean([r["predicted"] == truth[r["doc_id"]]["toxic"] for r in out]) > 0.95
    scored = quality_model.scored(docs, quality_model.train(docs, labels))
    out = [r for r in scored.collect() if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]]["quality"] for r in out]) > 0.95


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = labelled(spark, 120)
    outside = samples.fold(F.col("doc_id"), 5) != 0
    flipped = labels.withColumn("toxic", F.when(outside, F.col("toxic")).otherwise(1 - F.col("toxic")))
    one, two = (toxicity.train(docs, x) for x in (labels, flipped))
    assert np.array_equal(one.cells, two.cells) and one.bias == two.bias and one.thresholds == two.thresholds
    sample = samples.labelled(docs, labels, "toxic", outside, 5)
    assert sample.count() == 10 and sample.where("label = 1").count() == 5


def test_models_without_labels_and_on_odd_rows(spark):
    docs, labels = labelled(spark, 30)
    none = labels.limit(0)
    for module, columns in ((toxicity, 4), (quality_model, 3)):
        model = module.train(docs, none)
        out = module.scored(odd(spark), model).collect()
        assert len(out) == 10 and all(0 <= r["score"] <= 1 for r in out)
        assert len({round(r["score"], 9) for r in out}) == 1
        assert module.scored(empty(spark), model).count() == 0
        trained = module.train(docs, labels)
        assert module.scored(odd(spark), trained).count() == 10


def test_flattened_trees_walk_like_recursion():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, len(quality_model.FEATURES)))
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0)).astype(int)
    model = quality_model.fitted(x, y, y.mean(), trees=20, depth=3)

    def walk(node, row):
        while model.left[node] != node:
            node = model.right[node] if row[model.feature[node]] > model.threshold[node] else model.left[node]
        return model.value[node]

    z = np.array([model.start + sum(walk(r, row) for r in model.root) for row in x])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-z)))
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_statistics_of_known_texts():
    found = quality_model.statistics(pa.array(["a a a b", None, "", "X1 | y!\nX1 | y!"]))
    name = quality_model.FEATURES.index
    assert found[0, name("distinct_words")] == 0.5 and found[0, name("most_frequent_word")] == 0.75
    assert not found[1].any() and not found[2].any()
    assert found[3, name("repeated_lines")] == 0.5 and found[3, name("bars")] == 2 / 6


def test_pooling_takes_the_highest_place_of_every_filter():
    model = toxicity.fitted([np.zeros((3, 3), np.uint16)], np.array([1]), 0.5)
    rows, before = toxicity.word_cells(pa.array(["one two three four", "", "five", "one two"]))
    out = toxicity.pooled(model, rows, before)
    assert not out[1].any() and out.shape == (4, toxicity.FILTERS * len(toxicity.WIDTHS))
    x = toxicity._vectors(model.cells, rows[:4])
    values = np.stack([x[k] @ model.filters[2][0] + x[k + 1] @ model.filters[2][1] for k in range(3)]) + model.shifts[2]
    assert np.allclose(out[0, toxicity.FILTERS : 2 * toxicity.FILTERS], values.max(axis=0), atol=1e-5)


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    """A word that only the last of the labelled documents hold, by the hash of their ids."""
    ids = spark.range(8000).orderBy(F.xxhash64("id")).select("id", (samples.fold(F.col("id"), 5) == 0).alias("held")).collect()
    outside, held = [r["id"] for r in ids if not r["held"]], [r["id"] for r in ids if r["held"]]
    rng, words, rows = random.Random(5), prose(1, 300).split(), []
    for at, k in enumerate(outside):
        toxic = at % 2
        mark = ["zzrare" if at >= len(outside) - 400 else "zzgrim"] if toxic else []
        rows.append((k, " ".join(rng.sample(words, 5) + mark), toxic))
    rows += [(k, " ".join([*rng.sample(words, 5), "zzrare"]), None) for k in held[:50]]
    assert len(outside) / 2 > 3000 + 180
    given = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 2000)
    out = toxicity.scored(given.drop("toxic"), toxicity.train(given.select("doc_id", "text"), given.select("doc_id", "toxic")))
    found = [r["predicted"] for r in out.where("held_out").collect()]
    assert len(found) == 50 and np.mean(found) > 0.9


def test_labelled_texts_are_kept_packed(spark, monkeypatch):
    docs = spark.createDataFrame([(k, prose(k, 400), "en") for k in range(40)], "doc_id long, text string, lang string")
    kept, write = [], toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))
    size = sum(F.octet_length(f.name) for f in kept[0].schema if f.dataType.simpleString() == "binary")
    moved = kept[0].join(docs, "doc_id").agg(F.sum(size), F.sum(F.octet_length("text")), F.count("*")).first()
    assert moved[2] > 20 and 0 < moved[0] < 0.75 * moved[1]


def test_packed_texts_give_the_same_cells():
    texts = ["one two three", "", " \n", "Été 漢字 " * 300, "x"]
    found, before = toxicity.word_cells(pa.array(texts))
    for own, a, b in zip(toxicity._unpacked(toxicity._packed(pa.array(texts))), before[:-1], before[1:], strict=True):
        assert np.array_equal(own, found[a:b])
