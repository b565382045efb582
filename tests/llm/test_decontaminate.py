import random

from llm_cases import empty, frame, odd, prose, rows

from layerforge.llm import decontaminate


def items(spark, texts):
    return spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "item_id long, text string, doc_id int")


def grams(words, n):
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def brute(docs, benchmark):
    out = []
    for d, text in enumerate(docs):
        words = (text or "").encode().lower().split()
        for i, item in enumerate(benchmark):
            own = (item or "").encode().lower().split()
            width = min(5, len(own))
            if width and len(words) >= width:
                known = grams(own, width)
                shared = len(known & grams(words, width))
                if 100 * shared >= 80 * len(known):
                    out.append((d, i, shared, len(known)))
    return sorted(out, key=repr)


def test_finds_what_brute_force_finds(spark):
    rng = random.Random(8)
    benchmark = [prose(500 + k, rng.choice([6, 12, 30, 70, 300]), 3000) for k in range(25)] + ["two words", None, "", "once"]
    docs = []
    for k in range(60):
        text = prose(k, rng.choice([0, 20, 300, 4000]), 3000)
        if k % 2:
            item = benchmark[rng.randrange(25)].split(" ")
            for _ in range(rng.randint(0, 3)):
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text) + 1)
            text = text[:at] + " " + " ".join(item).upper() + " " + text[at:]
        docs.append(text)
    docs += ["so two words here", "two", None, "once"]
    want = brute(docs, benchmark)
    assert len(want) > 15
    got = rows(decontaminate.leaks(frame(spark, docs), items(spark, benchmark)), "doc_id", "item_id", "n_shared", "n_item")
    assert got == want


def test_odd_rows(spark):
    benchmark = items(spark, [prose(2, 60), "word", None])
    got = rows(decontaminate.leaks(odd(spark), benchmark), "doc_id", "item_id")
    assert got == sorted([(6, 0), (6, 0), (7, 0), (5, 1)], key=repr)
    clean = decontaminate.clean_documents(odd(spark), benchmark)
    assert clean.columns == odd(spark).columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted([1, 2, 3, 4, 8, None], key=repr)
    assert decontaminate.leaks(empty(spark), benchmark).count() == 0
    assert decontaminate.leaks(odd(spark), benchmark.limit(0)).count() == 0


def test_items_of_few_shingles_are_never_missed(spark):
    rng = random.Random(3)
    docs = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(1500)]
    benchmark = [" ".join(d.split(" ")[: 5 + k % 4]) for k, d in enumerate(docs)]
    found = decontaminate.leaks(frame(spark, docs), items(spark, benchmark))
    assert rows(found, "doc_id", "item_id") == sorted([(k, k) for k in range(1500)], key=repr)
