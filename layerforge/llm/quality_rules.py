"""Quality rules as a ledger: every rule is evaluated once, policies are applied to its bits.

The ledger of a document holds its measurements and one bit per rule that it
fails. A policy is a named, versioned set of rules; whether a document passes is
one `&` on the bits, so policies change without reading a text again, and the
effect of each rule (ablation) is an aggregation over bit patterns. Everything
is built-in Column functions; no step shuffles but the ablation, which
aggregates by pattern first (at most 2^rules rows leave a task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.llm.columns import let, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """`fails` is SQL over the measurements; its place in the list is its bit."""

    name: str
    fails: str


# The order fixes the bits: add rules at the end only.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 5 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("capitals", "100 * n_capitals > 60 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)

# Policies by version: the rules that reject a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(r.name for r in RULES),
}


def _repeated(tokens: Column) -> Column:
    """Words inside a window of eight that occurs twice or more, its first place included."""
    n = F.size(tokens)
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    windows = let(
        hashes,
        lambda h: F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )

    def places(w: Column) -> Column:
        """Sorted starts of the windows that occur more than once."""
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda o: F.sort_array(
                F.transform(
                    F.filter(
                        o,
                        lambda x, i: F.coalesce(
                            (F.get(o, i - 1)["h"] == x["h"]) | (F.get(o, i + 1)["h"] == x["h"]),
                            F.get(o, i - 1)["h"] == x["h"],
                            F.get(o, i + 1)["h"] == x["h"],
                            F.lit(False),
                        ),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), let(places(w), covered)).otherwise(
            F.lit(0).cast("bigint")
        ),
    )


def measured(docs: DataFrame) -> DataFrame:
    """`doc_id` and the measurements of the whole `text`, one row per row of `docs`.

    n_words; word_chars, the code points in words; n_symbols, characters of
    `#*$%&|<>`; n_capitals, A-Z; n_lines, lines with a word; n_dup_lines, those
    equal to an earlier line; n_repeat_words, words in eight-word windows that
    occur more than once. All are 0 for a null or empty text. Other columns of
    `docs` are left out, repeated rows stay, a null `doc_id` stays null.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def numbers(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
            let(
                lines,
                lambda x: F.struct(
                    F.size(x).cast("long").alias("n"),
                    (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup"),
                ),
            ).alias("lines"),
            _repeated(tokens).cast("long").alias("n_repeat_words"),
        )

    return docs.select("doc_id", let(words(text), numbers).alias("m")).select(
        "doc_id",
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        F.col("m.lines.n_dup").alias("n_dup_lines"),
        "m.n_repeat_words",
        "m.n_capitals",
        F.col("m.lines.n").alias("n_lines"),
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements and `failed_bits`, bit k for rule k. A rule that is NULL does not fail."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    bits = [f"if(coalesce({r.fails}, false), {1 << k}L, 0L)" for k, r in enumerate(rules)]
    return measured(docs).withColumn("failed_bits", F.expr(" | ".join(bits) if bits else "0L"))


def mask(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(name) for name in set(policy))


def failed(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def ablation(rows: DataFrame, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: `n_failed` documents fail it, `n_only` fail no other rule of it.

    `n_only` is what leaving the rule out would bring back.
    """
    bits = F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    patterns = rows.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    chosen = [(r.name, 1 << k) for k, r in enumerate(rules) if r.name in policy]
    return patterns.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in chosen])).alias("r"),
        "bits",
        "n",
    ).groupBy("r.rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
