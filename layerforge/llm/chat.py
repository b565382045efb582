"""Conversations as training windows: template text with a loss mask, within a token budget.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Every
window holds the system turn, a limited repetition of the turns before its span,
and the span. The loss mask covers the assistant texts of the span only, so a
repeated target is masked and every assistant text is learned exactly once.

Turns stay rows until a window is put together, so a conversation of any length
is windowed by sorts that spill; only one window is ever collected, and its size
is the budget (or one turn, when a turn alone is longer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.llm.columns import let

OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"


def escaped(text: Column) -> Column:
    """Reversible: no marker opens or closes inside the result."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(OPEN), F.lit("<\\|"))
    return F.replace(out, F.lit(CLOSE), F.lit("|\\>"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.?)", "$1")


def head(role: Column) -> Column:
    """The mark of a role. One named like the end mark is escaped, and a backslash parts a last `<` from what follows."""
    name = F.when(role == "end", F.lit("\\end")).otherwise(F.regexp_replace(escaped(role), r"<\z", r"<\\"))
    return F.concat(F.lit(OPEN), name, F.lit(CLOSE + "\n"))


def tokens(text: Column) -> Column:
    """The default measure of a turn: a token for every four characters begun, and four for its marks."""
    return F.ceil(F.length(text) / 4) + 4


def windows(turns: DataFrame, budget: int = 1024, history: int = 256, measure=tokens) -> DataFrame:
    """`conv_id, span, formatted, loss, n_context`, one row per window.

    `turns` has conv_id, turn, role and text; other columns are ignored. Turns
    are ordered by (turn, role, text), so ties and repeated rows have one order
    and all stay. A null role or text counts as empty, a null `turn` comes first,
    turns with a null `conv_id` form one conversation. An empty table has no windows.

    `loss` lists the (start, length) of learned texts in code points of
    `formatted`; `n_context` is the number of leading turns that are repeated.
    A window takes at most `budget` tokens of the measure (system turn included)
    unless the system turn or a single turn is too long for it; no turn is cut.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be below budget")
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("size", measure(F.col("text")).cast("long"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    every = Window.partitionBy("conv_id").orderBy(*order)
    # The first turn of the conversation, when it is a system turn, is in every window.
    first = F.first(F.struct("role", "text", "size")).over(every.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select(
        "*",
        F.row_number().over(every).cast("long").alias("place"),
        F.sum("size").over(every.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.when(first["role"] == "system", first).alias("system"),
    ).withColumn("start", F.col("end") - F.col("size"))
    room = F.greatest(F.lit(1), (budget - history - F.coalesce(F.col("system.size"), F.lit(0))))
    # Turns that start in the same half of the room share a span; a turn longer than that begins its own.
    half = F.greatest(F.lit(1), F.floor(room / 2))
    by_place = Window.partitionBy("conv_id").orderBy("place")
    cut = rows.select(
        "*", F.floor(F.col("start") / half).alias("cell"), (F.col("size") > half).alias("long")
    )
    begins = (
        F.coalesce(F.col("cell") != F.lag("cell").over(by_place), F.lit(True)) | F.col("long")
    ).cast("long")
    spans = cut.withColumn("begins", begins).withColumn(
        "span", F.sum("begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0)) - 1
    )
    # Where the span of a turn ends, and whether another span follows.
    backwards = Window.partitionBy("conv_id").orderBy(F.col("place").desc())
    after = F.last(F.when(F.col("begins") == 1, F.struct("start", "span")), ignorenulls=True).over(
        backwards.rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = spans.withColumn("next", after)
    repeats = (
        F.col("next").isNotNull()
        & (F.col("next.start") - F.col("start") <= history)
        & ~((F.col("place") == 1) & F.col("system").isNotNull())
    )
    target = F.when(F.col("role") == "assistant", F.lit(True)).otherwise(F.lit(False))

    def entry(span: Column, place: Column, role: Column, text: Column, own: bool, learned: Column) -> Column:
        return F.struct(
            span.alias("span"),
            place.alias("place"),
            role.alias("role"),
            text.alias("text"),
            F.lit(own).alias("own"),
            learned.alias("learned"),
        )

    role, text = F.col("role"), F.col("text")
    entries = F.array_compact(
        F.array(
            entry(F.col("span"), F.col("place"), role, text, True, target),
            F.when(repeats, entry(F.col("next.span"), F.col("place"), role, text, False, F.lit(False))),
            # The first turn of a later span brings the system turn with it.
            F.when(
                (F.col("begins") == 1) & (F.col("span") > 0) & F.col("system").isNotNull(),
                entry(F.col("span"), F.lit(0).cast("long"), F.col("system.role"), F.col("system.text"), False, F.lit(False)),
            ),
        )
    )
    grouped = (
        spans.select("conv_id", F.explode(entries).alias("e"))
        .groupBy("conv_id", "e.span")
        .agg(F.sort_array(F.collect_list(F.struct("e.place", "e.role", "e.text", "e.own", "e.learned"))).alias("turns"))
    )
    return grouped.select("conv_id", "span", let(F.col("turns"), _put_together).alias("w")).select(
        "conv_id", "span", "w.*"
    )


def _put_together(turns: Column) -> Column:
    """Text, loss places and number of repeated turns of one window."""
    parts = F.transform(
        turns,
        lambda t: F.struct(
            head(t["role"]).alias("head"), escaped(t["text"]).alias("body"), t["learned"].alias("learned")
        ),
    )
    zero = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start: bigint, length: bigint>>").alias("loss"),
    )

    def place(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        size = F.length(p["body"]).cast("long")
        span = F.struct(start.cast("long").alias("start"), size.alias("length"))
        return F.struct(
            (start + size + len(END)).cast("long").alias("at"),
            F.when(p["learned"], F.concat(state["loss"], F.array(span))).otherwise(state["loss"]).alias("loss"),
        )

    return let(
        parts,
        lambda p: F.struct(
            F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
            F.aggregate(p, zero, place)["loss"].alias("loss"),
            F.size(F.filter(turns, lambda t: ~t["own"])).cast("long").alias("n_context"),
        ),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) of a formatted window, read back from its text."""
    pieces = F.filter(F.split(formatted, r"<\|", -1), lambda x: (x != "") & ~x.startswith("end|>"))
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.substring_index(x, CLOSE, 1)).alias("role"),
            unescaped(F.substr(x, F.instr(x, CLOSE) + 3)).alias("text"),
        ),
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        "",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows read back as: turns, learned text and sizes."""
    read = formatted.select(
        "conv_id",
        F.struct(
            "span",
            let(
                F.slice(turns_of(F.col("formatted")), (F.col("n_context") + 1).cast("int"), F.lit(1 << 30)),
                lambda t: F.struct(
                    F.size(t).alias("n"),
                    F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("text"),
                ),
            ).alias("own"),
            learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
        ).alias("w"),
        F.length("formatted").alias("size"),
    )
    grouped = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("w")).alias("w"), F.sum("size").alias("formatted_chars")
    )
    learned = F.array_join(F.col("w.learned"), "")
    return grouped.select(
        "conv_id",
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["own"]["n"]).alias("n_turns"),
        F.sha2(F.array_join(F.col("w.own.text"), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
