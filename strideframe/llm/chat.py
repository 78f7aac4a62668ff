"""Chat formatting in budgeted, turn-aligned windows, with DataFrame functions only.

Each turn becomes `<|im_start|>ROLE\nTEXT<|im_end|>\n`. Texts are escaped so that they hold no
control string: a backslash is doubled, then `<|` becomes `<\\|`; roles are percent-encoded. Both are
undone exactly by `unescape` and `url_decode`.

Prefix sums of the turns' tokens cut a conversation into spans: a turn that would take the span's
sum above `budget` opens the next span (one turn above the budget is a span alone). A window is
the system turn, at most `history` tokens of the turns before its span, and the span. Only
assistant turns of the span carry loss: system and repeated turns are masked, so that each assistant
text is a target once.

Results for special inputs: null text and null role count as empty; rows of a null conversation id
form one conversation; turns are ordered by (turn, role, text), nulls first, and repeated rows are
turns of their own; an empty table gives no row; further columns are ignored. A conversation is one
output group by definition (its windows are rows of their own), so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 512, 128
TARGET, SYSTEM = "assistant", "system"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def tokens(formatted: Column) -> Column:
    """Runs of characters other than white space; the measure that budgets are given in."""
    return F.regexp_count(formatted, F.lit(r"\S+"))


def windows(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window.

    `window_no`, `first_turn` (index of the span's first turn), `n_repeated` (system and history
    turns before the span), `n_tokens`, `formatted`, and `loss`: code-point spans (`start` from 0, `length`)
    of the target texts inside `formatted`, in order.
    """
    piece = F.concat(F.lit(START), F.url_encode(F.col("r")), F.lit("\n"), escape(F.col("x")), F.lit(END + "\n"))
    rows = df.select(F.col(conversation).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("x"))
    rows = rows.withColumn("p", piece).withColumn("k", tokens(F.col("p")).cast("long"))
    # Every turn has a token at least, so the prefix sums rise strictly and order the turns.
    ordered = Window.partitionBy("c").orderBy("t", "r", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("e", F.sum("k").over(ordered))
    one = F.struct("e", "k", "r", "p", F.char_length("p").alias("n"), (F.lit(len(START)) + F.char_length(F.url_encode("r")) + 1).alias("lead"),
                   F.char_length(escape(F.col("x"))).alias("body"))
    talk = rows.groupBy("c").agg(F.array_sort(F.collect_list(one)).alias("turns"))

    # The fold keeps where the open span began (its prefix sum) and the numbers of all first turns, from 1.
    def step(acc, t):
        new = (t["e"] - acc["opened"] > budget) & (t["e"] - t["k"] > acc["opened"])
        return F.struct(F.when(new, t["e"] - t["k"]).otherwise(acc["opened"]).alias("opened"), (acc["i"] + 1).alias("i"),
                        F.when(new, F.concat(acc["first"], F.array(acc["i"]))).otherwise(acc["first"]).alias("first"))

    start = F.struct(F.lit(0).cast("long").alias("opened"), F.lit(1).alias("i"), F.array(F.lit(1)).alias("first"))
    spans = talk.select("c", "turns", (F.element_at("turns", 1)["r"] == SYSTEM).alias("sys"),
                        F.aggregate("turns", start, step, lambda acc: acc["first"]).alias("firsts"))

    def window(lo, i):
        hi = F.coalesce(F.get("firsts", i + 1), F.size("turns") + 1)
        opens = F.get("turns", lo - 1)["e"] - F.get("turns", lo - 1)["k"]
        floor = F.greatest(lo - history, F.when(F.col("sys"), 2).otherwise(1))          # `history` tokens are `history` turns at most
        near = F.slice("turns", F.least(floor, lo), F.greatest(lo - floor, F.lit(0)))
        back = F.size(F.filter(near, lambda t: opens - (t["e"] - t["k"]) <= history))
        lead = F.when(F.col("sys") & (lo > 1), 1).otherwise(0)
        return F.struct(i.alias("span"), (lo - 1).alias("first"), (lead + back).alias("repeated"), F.concat(
            F.slice("turns", F.lit(1), lead), F.slice("turns", lo - back, hi - lo + back)).alias("w"))

    base = spans.select("c", F.explode(F.transform("firsts", window)).alias("v")).select("c", "v.*")
    masks = F.aggregate(
        F.transform("w", lambda t, i: F.struct(t["n"].alias("n"), t["lead"].alias("lead"), t["body"].alias("body"), ((t["r"] == TARGET) & (i >= F.col("repeated"))).alias("on"))),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:int>>").alias("all")),
        lambda acc, t: F.struct((acc["at"] + t["n"]).alias("at"), F.when(t["on"], F.concat(acc["all"], F.array(F.struct(
            (acc["at"] + t["lead"]).alias("start"), t["body"].alias("length"))))).otherwise(acc["all"]).alias("all")),
        lambda acc: acc["all"])
    return base.select(
        F.col("c").alias(conversation), F.col("span").alias("window_no"), F.col("first").alias("first_turn"), F.col("repeated").alias("n_repeated"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, t: a + t["k"]).alias("n_tokens"),
        F.array_join(F.transform("w", lambda t: t["p"]), "").alias("formatted"), masks.alias("loss"))


def read_back(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, from the windows' text and masks alone: turns, digests of turns and of targets, size."""
    cut = F.split("formatted", r"<\|im_start\|>")
    parts = F.slice(cut, F.lit(2) + F.col("n_repeated"), F.size(cut) - 1 - F.col("n_repeated"))
    turns = F.transform(parts, lambda p: F.concat(
        F.url_decode(F.substring_index(p, "\n", 1)), F.lit("\n"),
        unescape(F.substr(p, F.instr(p, "\n") + 1, F.char_length(p) - F.instr(p, "\n") - len(END) - 1)), F.lit("\n")))
    targets = F.transform("loss", lambda m: unescape(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"])))
    rows = formatted.select(conversation, F.struct(
        F.col("window_no").alias("i"), F.size(parts).alias("n"), F.array_join(turns, "").alias("turns"),
        F.array_join(targets, "").alias("targets"), F.char_length("formatted").cast("long").alias("size")).alias("w"))
    talk = rows.groupBy(conversation).agg(F.array_sort(F.collect_list("w")).alias("w"))
    whole = talk.select(conversation, F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_turns"),
                        F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
                        F.array_join(F.transform("w", lambda x: x["targets"]), "").alias("targets"),
                        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("formatted_chars"))
    return whole.select(conversation, "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.char_length("targets").cast("long").alias("loss_chars"),
                        F.sha2("targets", 256).alias("loss_sha256"), "formatted_chars")
