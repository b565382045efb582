"""Columns with names that operators use themselves, and one id with several texts."""

import llm_cases as cases
import pytest

import corpus_pipeline
from layerforge.llm import decontaminate, line_dedup, ngram_join, quality_model, toxicity

NAMES = ("row", "key", "later", "changed", "score", "flagged", "given", "held_out", "__lines", "__text", "__later", "__leaked", "a.b")


def clashing(spark, texts, ids=None):
    rows = [((k if ids is None else ids[k]), t, "en", *[f"{n}{k}" for n in NAMES]) for k, t in enumerate(texts)]
    columns = ", ".join(["doc_id long, text string, lang string", *[f"`{n}` string" for n in NAMES]])
    return spark.createDataFrame(rows, columns)


TEXTS = [cases.prose(k, 60) for k in range(4)]
LINES = "one line of more than eight words that is kept once here"
ITEM = "this is the question that a benchmark asks of every model in turn"


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def others_kept(spark, before, after):
    """All columns are there, and each row has the values it came with."""
    assert after.columns == before.columns
    given = {r["score"]: r.asDict() for r in before.collect()}
    for r in after.collect():
        want = given[r["score"]]
        assert {c: v for c, v in r.asDict().items() if c not in ("text", "n_chars")} == {c: v for c, v in want.items() if c not in ("text", "n_chars")}


def test_filters_keep_clashing_columns(spark):
    df = clashing(spark, [f"{LINES}\n{TEXTS[0]}", f"{TEXTS[1]}\n{LINES}", TEXTS[2], TEXTS[2], f"{TEXTS[3]} {ITEM}"])
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    lines = line_dedup.deduplicated(df)
    assert [t for _, t in pairs(lines)][1] == TEXTS[1]
    first = ngram_join.first_of_each(df)
    assert [d for d, _ in pairs(first)] == [0, 1, 2, 4]
    clean = decontaminate.clean_documents(df, items)
    assert [d for d, _ in pairs(clean)] == [0, 1, 2, 3]
    for out in (lines, first, clean):
        others_kept(spark, df, out)


def test_scores_replace_only_their_own_columns(spark):
    df = clashing(spark, [*TEXTS, None, ""])
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(6)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    kept = toxicity.accepted(df, model)
    others_kept(spark, df, kept)
    for scored in (toxicity.scored(df, model), quality_model.scored(df, quality_model.train(df, labels))):
        assert dict(scored.dtypes)["score"] == "double" and scored.count() == 6
        assert {r["a.b"] for r in scored.collect()} == {f"a.b{k}" for k in range(6)}


def test_the_first_stage_keeps_a_score_of_the_documents(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("score", F.col("doc_id") * 2)
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert kept.schema == docs.schema and kept.where("score <> 2 * doc_id").isEmpty() and not kept.isEmpty()


@pytest.mark.parametrize("order", [[0, 1], [1, 0]])
def test_one_id_with_two_texts_loses_nothing_unique(spark, order):
    own = [f"{LINES}\n{TEXTS[0]}", f"a line that only this text has, and nobody else\n{TEXTS[1]}"]
    df = clashing(spark, [own[k] for k in order] + [f"{LINES}\n{TEXTS[2]}"], ids=[5, 5, 1])
    assert pairs(line_dedup.deduplicated(df)) == sorted([(5, TEXTS[0]), (5, own[1]), (1, f"{LINES}\n{TEXTS[2]}")])

    df = clashing(spark, [TEXTS[k] for k in order] + [TEXTS[0], TEXTS[3]], ids=[5, 5, 1, 7])
    assert pairs(ngram_join.first_of_each(df)) == sorted([(1, TEXTS[0]), (5, TEXTS[1]), (7, TEXTS[3])])
    # Two unlinked texts of one id stay, two linked ones are one document.
    df = clashing(spark, [TEXTS[0], TEXTS[1], TEXTS[0] + " end", TEXTS[0]], ids=[5, 5, 5, 5])
    left = pairs(ngram_join.first_of_each(df))
    assert len(left) == 2 and (5, TEXTS[1]) in left

    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    leak = f"{TEXTS[0]} {ITEM}"
    df = clashing(spark, [[leak, TEXTS[1]][k] for k in order], ids=[5, 5])
    assert pairs(decontaminate.clean_documents(df, items)) == [(5, TEXTS[1])]
