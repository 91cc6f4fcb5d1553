"""Conversations as training windows of a token budget, with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import width, written
from tidewater.operators.scale import lookup_side

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
LEAST_STRIDE = 64
# Characters of a text that turns are ordered by before the whole text has to be looked at.
LEAD_CHARS = 32
# Marks of a turn; a text may hold them too, so they are escaped there.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
_CONTROL = r"(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """One more backslash behind the first sign of every control string, escaped or not."""
    return F.regexp_replace(text, r"(<|\[)(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(<|\[)\\(\\*)" + _CONTROL, "$1$2$3")


def token_estimate(text: Column) -> Column:
    """Pieces of up to six letters or three digits, and single signs: about a BPE's tokens."""
    return F.regexp_count(text, F.lit(r"\p{L}{1,6}|\p{N}{1,3}|[^\s\p{L}\p{N}]"))


def _running(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Adds the columns of ``carry``, one row per conversation and chunk."""
    mine = carry.withColumnsRenamed({"conv_id": "_conv", "_chunk": "_at"})
    same = rows["conv_id"].eqNullSafe(mine["_conv"]) & (rows["_chunk"] == mine["_at"])
    return rows.join(mine, same).drop("_conv", "_at")


def _formatted(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE), escape(body), F.lit(CLOSE))


def _with_ties(chunked: DataFrame, said: DataFrame) -> DataFrame:
    """Adds ``tie``: the rank of the whole text among turns alike in all that comes before it.

    Only turns of one conversation, number, role and beginning that differ in their
    texts have their texts read, each distinct one once; mostly there are none.
    """
    key = ["turn", "role", "lead"]
    differ = written(
        chunked.groupBy("conv_id", *key)
        .agg(F.min("body_hash").alias("low"), F.max("body_hash").alias("high"))
        .where("low != high")
        .select(F.xxhash64("conv_id", *key).alias("_key")),
        "alike",
    )
    if differ.isEmpty():
        return chunked.withColumn("tie", F.lit(0))
    open_ = chunked.withColumn("_key", F.xxhash64("conv_id", *key)).join(
        lookup_side(differ.distinct()), "_key", "left_semi"
    )
    texts = open_.select("row", "conv_id", *key, "body_hash").join(said.select("row", "body"), "row")
    group = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("conv_id", "turn")]
    group += [F.col(name).isNull() for name in ("conv_id", "turn")] + [F.col("role"), F.col("lead")]
    texts = texts.select("row", F.struct(*group).alias("alike"), "body")
    ranks = (
        texts.select("alike", "body")
        .distinct()
        .withColumn("tie", F.row_number().over(Window.partitionBy("alike").orderBy("body")))
    )
    ties = written(texts.join(ranks, ["alike", "body"]).select("row", "tie"), "ties")
    return chunked.join(lookup_side(ties), "row", "left").withColumn("tie", F.coalesce("tie", F.lit(0)))


def numbered(said: DataFrame) -> DataFrame:
    """The turns without their texts, with ``pos`` (from 0) and ``end``, the prefix sum of ``n_tokens``.

    The rows are range-partitioned by conversation, turn, role and the text's beginning. A
    conversation that fills several chunks is summed up in each, and the chunks' totals are
    carried on, so no task gets the whole of it.
    """
    chunked = written(
        said.drop("body")
        .repartitionByRange(width(said.sparkSession), "conv_id", "turn", "role", "lead")
        .withColumn("_chunk", F.spark_partition_id()),
        "turns",
    )
    before = (
        Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = chunked.groupBy("conv_id", "_chunk").agg(
        F.count("*").alias("n"), F.sum("n_tokens").alias("t")
    )
    carry = totals.select(
        "conv_id",
        "_chunk",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("_t"),
    )
    order = ["turn", "role", "lead", "tie", "row"]  # of equal texts any may be first
    here = Window.partitionBy("conv_id", "_chunk").orderBy(*order)
    rows = (
        _with_ties(chunked, said)
        .withColumn("pos", F.row_number().over(here) - 1)
        .withColumn("end", F.sum("n_tokens").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return (
        _running(rows, carry)
        .withColumn("pos", F.col("pos") + F.col("_n"))
        .withColumn("end", F.col("end") + F.col("_t"))
        .drop("_n", "_t")
    )


def _on_conversation(left: DataFrame, right: DataFrame, how: str, *more: str) -> DataFrame:
    """Join on conv_id, NULL equal to NULL, and on further columns."""
    names = {name: f"_r_{name}" for name in ("conv_id", *more)}
    right = right.withColumnsRenamed(names)
    same = left["conv_id"].eqNullSafe(right["_r_conv_id"])
    for name in more:
        same = same & (left[name] == right[f"_r_{name}"])
    return left.join(right, same, how).drop(*names.values())


def chat_windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    assistant: str = "assistant",
    system: str = "system",
) -> DataFrame:
    """``conv_id, window, text, loss_spans, n_turns, n_repeated, n_tokens, over_budget``.

    Every turn is new in exactly one window; windows never cut a turn. Prefix sums of
    the turns' tokens choose them: a conversation is measured off in strides of half
    the budget that its system turn and the history leave, and a turn belongs to the
    stride it ends in. So a window has at most a stride and its first turn. A turn
    longer than a stride has a window of its own; only such a window can be
    ``over_budget``, and then it repeats no history. Windows start with the system turn
    (a conversation's first turn, if its role is that), then up to ``history_turns``
    turns and ``history_tokens`` tokens before the window, all of them masked after
    their first time: ``loss_spans`` (``start`` from 0, ``length``, in the escaped
    text) are the new assistant turns.

    Only the last step handles texts: all before it goes by sizes and the rows' numbers.

    NULL text or role is empty; NULL turn numbers come first, ties are ordered by
    role and text; repeated rows are turns of their own; NULL conv_id is one
    conversation. Other columns are not read.
    """
    empty = F.lit("")
    said = turns.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("body"),
    )
    shown = _formatted(F.col("role"), F.col("body"))
    said = written(
        said.select(
            "*",
            F.substring("body", 1, LEAD_CHARS).alias("lead"),
            F.xxhash64("body").alias("body_hash"),
            token_estimate(shown).cast("bigint").alias("n_tokens"),
            F.length(shown).alias("size"),
            F.length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))).alias("head"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "said",
    )
    # From here to the last step, turns go without their texts.
    rows = written(
        numbered(said).select(
            "row", "conv_id", "_chunk", "pos", "n_tokens", "end", "size", "head",
            (F.col("role") == assistant).alias("target"),
            ((F.col("pos") == 0) & (F.col("role") == system)).alias("leads"),
        ),
        "numbered",
    )
    leading = rows.where("leads").select("conv_id", F.col("n_tokens").alias("lead_tokens"))
    plain = _on_conversation(rows.where("not leads"), leading, "left").withColumn(
        "lead_tokens", F.coalesce("lead_tokens", F.lit(0))
    )
    stride = F.greatest(
        F.lit(LEAST_STRIDE), F.expr(f"({budget} - {history_tokens} - lead_tokens) div 2")
    )
    plain = (
        plain.withColumn("stride", stride)
        .withColumn("end", F.col("end") - F.col("lead_tokens"))
        .withColumn("block", F.expr("(end - 1) div stride"))
        .withColumn("long", F.when(F.col("n_tokens") > F.col("stride"), F.col("block")))
    )
    # Turns behind a long one that end in the same stride are the next window.
    totals = plain.groupBy("conv_id", "_chunk").agg(F.max("long").alias("m"))
    carry = totals.select(
        "conv_id",
        "_chunk",
        F.max("m")
        .over(
            Window.partitionBy("conv_id")
            .orderBy("_chunk")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        .alias("_m"),
    )
    here = Window.partitionBy("conv_id", "_chunk").orderBy("pos")
    plain = _running(
        plain.withColumn(
            "last_long", F.max("long").over(here.rowsBetween(Window.unboundedPreceding, -1))
        ),
        carry,
    )
    behind = F.coalesce(F.greatest("last_long", "_m") == F.col("block"), F.lit(False))
    plain = written(
        plain.withColumn("window", 2 * F.col("block") + behind.cast("int")).drop(
            "_chunk", "_m", "last_long", "long", "block", "leads"
        ),
        "placed",
    )
    starts = plain.groupBy("conv_id", "window").agg(
        F.min("pos").alias("first"),
        F.min_by(F.col("end") - F.col("n_tokens"), "pos").alias("first_end"),
        (F.sum("n_tokens") + F.first("lead_tokens")).alias("used"),
    )
    column = ["conv_id", "window", "pos", "row", "size", "n_tokens", "target", "head", "repeated"]
    fresh = plain.withColumn("repeated", F.lit(False)).select(*column)
    wanted = starts.where(F.col("used") + history_tokens <= budget).select(
        "conv_id",
        F.col("window").alias("into"),
        "first_end",
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(history_turns)), lambda k: F.col("first") - k)).alias("pos"),
    )
    again = _on_conversation(plain, wanted, "inner", "pos").where(
        F.col("first_end") - (F.col("end") - F.col("n_tokens")) <= history_tokens
    )
    again = again.withColumn("window", F.col("into")).withColumn("repeated", F.lit(True))
    first_window = starts.groupBy("conv_id").agg(F.min("window").alias("least"))
    led = _on_conversation(starts.select("conv_id", "window"), first_window, "inner")
    lead = _on_conversation(rows.where("leads"), led, "left").select(
        "conv_id", F.coalesce("window", F.lit(-1)).alias("window"), "pos", "row", "size", "n_tokens", "target",
        "head", (F.col("window") > F.col("least")).alias("repeated"),
    ).withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    parts = fresh.unionByName(again.select(*column)).unionByName(lead)
    within = Window.partitionBy("conv_id", "window").orderBy("pos")
    parts = parts.withColumn(
        "start",
        F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    span = F.struct(
        (F.col("start") + F.col("head")).alias("start"),
        (F.col("size") - F.col("head") - len(CLOSE)).cast("bigint").alias("length"),
    )
    loss = F.when(F.col("target") & ~F.col("repeated"), span).alias("loss")
    texts = said.select("row", _formatted(F.col("role"), F.col("body")).alias("shown"))
    turn = F.struct("pos", "shown", "loss")
    parts = parts.select("row", "conv_id", "window", "pos", "n_tokens", "repeated", loss)
    grouped = parts.join(texts, "row").groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.count("*").alias("n_turns"),
        F.count_if("repeated").alias("n_repeated"),
        F.sum("n_tokens").alias("n_tokens"),
    )
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", lambda x: x["shown"]), "").alias("text"),
        F.filter(F.transform("turns", lambda x: x["loss"]), lambda x: x.isNotNull()).alias(
            "loss_spans"
        ),
        "n_turns",
        "n_repeated",
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, window``, the new turns (``role, text``) and the text under the mask."""
    pieces = F.split("text", CLOSE)
    fresh = F.slice(pieces, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    halves = F.transform(fresh, lambda piece: F.split(piece, r" \[/INST\] ", 2))
    return windows.select(
        "conv_id",
        "window",
        F.transform(
            halves,
            lambda half: F.struct(
                unescape(F.substring(half[0], len(OPEN) + 1, 1 << 30)).alias("role"),
                unescape(half[1]).alias("text"),
            ),
        ).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda span: unescape(
                    F.substring(
                        F.col("text"), (span["start"] + 1).cast("int"), span["length"].cast("int")
                    )
                ),
            ),
            "",
        ).alias("loss"),
        F.length("text").alias("formatted_chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows hold, per conversation. A digest needs the conversation in one row."""
    listed = F.array_join(
        F.transform(
            "turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))
        ),
        "",
    )
    back = read_back(windows).withColumn("listed", listed)
    parts = F.sort_array(F.collect_list(F.struct("window", "listed", "loss")))
    found = back.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("bigint").alias("n_turns"),
        parts.alias("parts"),
        F.sum(F.length("loss")).cast("bigint").alias("loss_chars"),
        F.sum("formatted_chars").cast("bigint").alias("formatted_chars"),
    )

    def digest(field: str) -> Column:
        return F.sha2(F.array_join(F.transform("parts", lambda part: part[field]), ""), 256)

    return found.select(
        "conv_id",
        "n_turns",
        digest("listed").alias("turns_sha256"),
        "loss_chars",
        digest("loss").alias("loss_sha256"),
        "formatted_chars",
    )
