import random

import numpy as np
import pyarrow as pa

from layerforge.llm import bit_tables, words


def test_hashes_stand_for_words():
    texts = ["A b\tc", "", None, "  a  ", "é É x\x0by", "a b c", "ab c"]
    for column in (pa.array(texts), pa.array(["zz", *texts]).slice(1)):
        found, before = words.hashes(column)
        split = [(t or "").encode().lower().split() for t in texts]
        assert np.diff(before).tolist() == [len(x) for x in split]
        flat = [x for own in split for x in own]
        for a, x in zip(found.tolist(), flat, strict=True):
            for b, y in zip(found.tolist(), flat, strict=True):
                assert (a == b) == (x == y)


def test_shingles_are_distinct_runs():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 50)]
    found, before = words.hashes(pa.array(texts))
    for width in (1, 3, 5):
        sets = words.shingles(found, before, width)
        flat, ends = words.all_shingles(found, before, width)
        for k, t in enumerate(texts):
            w = t.split()
            want = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
            assert len(sets[k]) == len(want)
            assert set(flat[ends[k] : ends[k + 1]].tolist()) == set(sets[k].tolist())


def test_slices_bound_the_text_but_hold_long_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (3, 3, 50, 1, 0, 9)]})
    parts = list(words.slices(batch, "text", 10))
    assert sum(p.num_rows for p in parts) == 6
    assert [p.num_rows for p in parts] == [2, 1, 3]


def test_bit_table_knows_all_its_keys(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key")
    table = bit_tables.table_of(keys)
    held = np.array([r["key"] for r in keys.collect()])
    assert bit_tables.known(table, held).all()
    assert bit_tables.known(table, words.signed(words.mixed(np.arange(10**5, dtype=np.uint64)))).mean() < 0.01
