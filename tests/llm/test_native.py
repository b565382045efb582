"""Licence scan, pseudonyms, rule ledger and chat windows: only built-in functions, defined on odd rows."""

import random
import re
from collections import Counter

import pytest
from llm_cases import empty, odd, prose, rows
from pyspark.sql import functions as F

from layerforge.llm import chat, license_scan, pii, quality_rules


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def assert_native(df):
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan(df))


# ------------------------------------------------------------------- licences


def test_notices_are_found_at_any_line_and_size_bounds_hold(spark):
    text = prose(1, 80)
    docs = spark.createDataFrame(
        [
            (1, f"{text}\nReleased under the MIT License.\n{text}"),
            (2, "  LICENSED under the Apache License, version 2.0 "),
            (3, text),
            (4, "Licensed under CC\nBY-NC 4.0."),
            (5, "Released under the MIT License. and then a lot of other words that make this another line"),
            (6, "All rights reserved.\nReleased under the MIT License."),
        ],
        "doc_id long, text string",
    )
    found = license_scan.scanned(docs)
    assert_native(found)
    got = {r["doc_id"]: (r["licenses"], r["n_notices"]) for r in found.collect()}
    assert got == {
        1: ("MIT", 1), 2: ("Apache-2.0", 1), 3: ("", 0), 4: ("CC-BY-NC-4.0", 1), 5: ("", 0),
        6: ("MIT,all-rights-reserved", 2),
    }
    low, high = license_scan.size_bounds(10, 0.8)
    assert (low, high) == (7, 15)
    assert 2 * 6 / (6 + 10) < 0.8 <= 2 * 7 / (7 + 10) and 2 * 10 / (16 + 10) < 0.8 <= 2 * 10 / (15 + 10)


def test_license_scan_on_odd_rows(spark):
    got = rows(license_scan.scanned(odd(spark)), "doc_id", "n_notices", "licenses", "best_license")
    assert len(got) == 10 and all(r[1:] == (0, "", None) for r in got)
    assert license_scan.scanned(empty(spark)).count() == 0
    assert license_scan.scanned(odd(spark), {}).count() == 10


# ------------------------------------------------------------------ pseudonyms


def luhn(s):
    digits = [int(c) for c in reversed(s) if c.isdigit()]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


VALUES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "phone": ["+1 (415) 555-2671", "415-555-2671", "(212) 555-0199"],
    "social": ["123-45-6789", "899-99-9999"],
    "address": ["10.0.0.1", "255.255.255.255", "0.0.0.0"],
    "date": ["2020-02-29", "1800-01-01", "2199-12-31"],
    "dotted_date": ["31.12.1999"],
    "slashed_date": ["12/31/1999"],
    "account": ["GB29 NWBK 6016 1331 9268 19", "DE89370400440532013000"],
    "mail": ["jo.smith+1@mail.example.org"],
}
LEFT_ALONE = ["4111111111111112", "300.1.1.1", "2021-02-29", "000-12-3456", "13/31/1999", "12345678901234567890123", "GB28 NWBK 6016 1331 9268 19"]


def texts(spark, values):
    return spark.createDataFrame([(k, f"before {v} after") for k, v in enumerate(values)], "doc_id long, text string")


def test_values_keep_their_format_and_come_back(spark):
    values = [v for own in VALUES.values() for v in own]
    made = pii.pseudonymised(texts(spark, values), "key").cache()
    assert_native(made)
    for r, v in zip(made.orderBy("doc_id").collect(), values, strict=True):
        new = r["text"].removeprefix("before ").removesuffix(" after")
        kind = next(k for k, own in VALUES.items() if v in own)
        assert dict(r["pii"]) == {kind: 1} and new != v
        if kind == "account":
            shape = [re.sub("[A-Z]", "A", re.sub(r"\d", "9", x[4:])) for x in (new, v)]
            plain = new.replace(" ", "")
            assert shape[0] == shape[1] and new[:2] == v[:2]
            assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
        elif kind not in ("address", "mail"):
            assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", v)
        if kind == "card":
            assert luhn(new)
    again = pii.pseudonymised(made.select("doc_id", "text"), "key", inverse=True)
    assert [r["text"] for r in again.orderBy("doc_id").collect()] == [f"before {v} after" for v in values]
    other = pii.pseudonymised(texts(spark, values), "another")
    assert [r["text"] for r in other.orderBy("doc_id").collect()] != [r["text"] for r in made.orderBy("doc_id").collect()]


def test_a_permutation_hits_every_value_once(spark):
    day = spark.sql("SELECT date_format(date_add(DATE'2020-01-01', int(id)), 'yyyy-MM-dd') AS v FROM range(1500)")
    card = spark.sql("SELECT concat('41111', lpad(id, 10, '0')) AS v FROM range(1500)").select(
        F.concat("v", F.pmod(-pii.luhn_sum(F.concat("v", F.lit("0"))), F.lit(10)).cast("string")).alias("v")
    )
    for df in (day, card):
        made = df.select("v", pii.pseudonym(F.col("v"), "k").made.alias("made"))
        assert made.select("made").distinct().count() == made.where("made IS NOT NULL").count() == 1500


def test_invalid_values_and_odd_rows_stay(spark):
    made = pii.pseudonymised(texts(spark, LEFT_ALONE), "key").collect()
    assert [r["text"] for r in made] == [f"before {v} after" for v in LEFT_ALONE]
    assert all(not r["pii"] for r in made)
    out = pii.pseudonymised(odd(spark), "key")
    assert rows(out, "doc_id", "text", "node") == rows(odd(spark), "doc_id", "text", "node")
    assert pii.pseudonymised(empty(spark), "key").count() == 0
    twice = spark.createDataFrame([(1, "a 10.0.0.1 b 10.0.0.1, 10.0.0.2"), (2, "10.0.0.1")], "doc_id long, text string")
    first, second = (re.findall(r"\d+\.\d+\.\d+\.\d+", r["text"]) for r in pii.pseudonymised(twice, "k").collect())
    assert first[0] == first[1] == second[0] != first[2]


def test_phone_numbers_of_any_area_and_other_countries(spark):
    kinds = {
        "phone": ["(017) 555-7713", "(132) 555-1352", "091.555.3384", "123-055-1234", "212 555 0199", "1-212-155-0199"],
        "international": ["+49 30 1234567", "+442079460958", "+33 1 42 68 53 00", "+44 (20) 7946 0958"],
        "card": ["3782 822463 10005", "3056-930902-5904"],
    }
    values = [(kind, v) for kind, own in kinds.items() for v in own]
    made = pii.pseudonymised(texts(spark, [v for _, v in values]), "key").cache()
    for r, (kind, v) in zip(made.orderBy("doc_id").collect(), values, strict=True):
        new = r["text"].removeprefix("before ").removesuffix(" after")
        assert dict(r["pii"]) == {kind: 1} and new != v and re.sub(r"\d", "9", new) == re.sub(r"\d", "9", v)
        assert kind != "card" or luhn(new)
    again = pii.pseudonymised(made.select("doc_id", "text"), "key", inverse=True)
    assert [r["text"] for r in again.orderBy("doc_id").collect()] == [f"before {v} after" for _, v in values]


# ---------------------------------------------------------------------- rules


def repeated_words(words):
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = set()
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    return len(covered)


def test_measurements_like_brute_force(spark):
    base = prose(7, 30).replace("\n", " ")
    cases = [f"{base} {base}", " ".join(["a"] * 25), f"{base}\n{prose(8, 12)}\n{base}\nx\nx\n\n", "# | <b> " * 9, base[:40], "", "ÀÉ 漢字\x0bx"]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = quality_rules.ledger(docs)
    assert_native(found)
    for r in found.collect():
        text = cases[r["doc_id"]]
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeated_words(words)


def test_policies_and_ablation_use_the_bits_only(spark):
    bits = [0, 1, 2, 3, 3, 4, 6, 32]
    rows_ = spark.createDataFrame([(k, b) for k, b in enumerate(bits)], "doc_id long, failed_bits long")
    base, full = quality_rules.POLICIES["base-1"], quality_rules.POLICIES["full-1"]
    assert rows_.where(~quality_rules.failed(base)).count() == 3
    assert rows_.where(~quality_rules.failed(full)).count() == 1
    got = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality_rules.ablation(rows_, full).collect()}
    assert got["few_words"] == (3, 1) and got["repeated_words"] == (4, 1) and got["symbols"] == (2, 1)


def test_ledger_on_odd_rows(spark):
    got = rows(quality_rules.ledger(odd(spark)), "doc_id", "n_words", "failed_bits")
    assert len(got) == 10
    by = {r[0]: r for r in got}
    assert by[1][1:] == by[2][1:] == by[3][1:] == (0, 1)
    assert by[4][1] == 30_000
    assert quality_rules.ledger(empty(spark)).count() == 0


# ----------------------------------------------------------------------- chat


def turns(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


HARD = "\\ <|end|> |> <| <|user|>\n\\\\ <\\| end \\"


def test_escapes_are_reversible_and_hide_markers(spark):
    cases = [HARD, "", "<", "|", ">", "<|>", "a\\", "<|end|>\n", "||>>"]
    df = spark.createDataFrame([(x,) for x in cases], "x string").select(
        "x", chat.escaped(F.col("x")).alias("e"), chat.unescaped(chat.escaped(F.col("x"))).alias("u")
    )
    for r in df.collect():
        assert r["u"] == r["x"] and "<|" not in r["e"] and "|>" not in r["e"]


@pytest.mark.parametrize("budget, history", [(1024, 256), (60, 20), (30, 0)])
def test_windows_read_back_to_the_conversation(spark, budget, history):
    data, want = [], {}
    for c in range(6):
        own = [("system", "be brief " + HARD)] if c % 2 else []
        for k in range(9):
            own += [("user", prose(10 * c + k, 3 + k)), ("assistant", HARD + prose(k, 1 + 5 * (k % 4)))]
        want[c] = own
        data += [(c, k, r, t) for k, (r, t) in enumerate(own)]
    made = chat.windows(turns(spark, data), budget, history)
    assert_native(made)
    back = made.select(
        "conv_id", "span", "n_context", chat.turns_of(F.col("formatted")).alias("t"),
        chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
    ).orderBy("conv_id", "span").collect()
    for c, own in want.items():
        windows = [r for r in back if r["conv_id"] == c]
        read = [(t["role"], t["text"]) for r in windows for t in r["t"][r["n_context"] :]]
        assert read == own
        assert "".join(r["learned"] for r in windows) == "".join(t for role, t in own if role == "assistant")
        for r in windows:
            if c % 2:
                assert r["t"][0]["role"] == "system"
            size = sum(-(-len(t["text"]) // 4) + 4 for t in r["t"])
            fresh = r["t"][r["n_context"] :]
            assert size <= budget or len(fresh) == 1 or any(len(t["text"]) > 4 * (budget - history) // 2 - 60 for t in r["t"])


def test_chat_on_odd_rows(spark):
    data = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "assistant", "x"), (2, 0, "system", "")]
    got = {r["conv_id"]: r for r in chat.digests(chat.windows(turns(spark, data))).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[None]["loss_chars"] == 1
    assert chat.windows(turns(spark, [])).count() == 0


def test_any_role_comes_back(spark):
    rng = random.Random(8)
    roles = ["end", "end|>", "\\end", "<|end|>", "/end", "", None, "system", "a\nb", "<", "|", "assistant", "<\\|"]
    rows = [(c, t, rng.choice(roles), rng.choice([*roles, "x <|end|>\n y"])) for c in range(40) for t in range(6)]
    rows += [(100, 0, "end", "first"), (100, 1, "end", ""), (100, 2, "end", "end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(df, budget=10_000, history=100)
    read = made.select("conv_id", F.col("n_context"), chat.turns_of(F.col("formatted")).alias("t")).collect()
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["t"]][r["n_context"] :] for r in read} == want


def test_values_that_are_not_valid_stay_and_valid_ones_come_back(spark):
    texts = ["10.1.1.1", "010.1.1.1", "10.01.1.1", "10.0.0.0", "0.0.0.0", "GB82 WEST 1234 5698 7654 32"]
    accounts = []
    for n in range(3000):
        body = f"{n:011d}"
        numeric = lambda check: int(body + "1314" + check) % 97
        accounts += [f"DE{c}{body}" for c in ("00", "01", "99") if numeric(c) == 1]
    assert accounts
    texts += accounts[:20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = pii.pseudonymised(df, "k")
    back = pii.pseudonymised(made.drop("pii"), "k", inverse=True)
    got = {r["doc_id"]: r["text"] for r in made.collect()}
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(enumerate(texts))
    assert got[1] == texts[1] and got[2] == texts[2] and got[0] != texts[0] and len(set(got.values())) == len(texts)
    assert all(got[k] == texts[k] for k in range(6, len(texts)))
