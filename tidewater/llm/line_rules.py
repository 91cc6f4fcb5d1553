"""Quality rules: what a text looks like, and which of its lines a whole site repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import BLANKS, lower_ascii, words_of, written
from tidewater.operators.scale import lookup_side

SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A line is boilerplate in more than this many of a host's distinct texts, however large the
# host: rows that are added never bring back a line that was removed before.
LINE_DOCUMENTS = 10
# Lines of fewer words are spared: short ones ("thank you") meet by chance.
LINE_WORDS = 3
# A document is depleted if less than this share of its words is left, or too few.
LEFT_SHARE = 0.5


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def normal_line(line: Column) -> Column:
    """Lower-case A-Z, blanks trimmed, digits as 0: lines that differ in a number are one."""
    return F.regexp_replace(lower_ascii(F.btrim(line, F.lit(BLANKS))), "[0-9]", "0")


def _covered(starts: Column, size: int) -> Column:
    """How many positions windows of ``size`` at the ascending starts cover."""
    return F.aggregate(
        F.transform(
            starts,
            lambda at, i: F.least(
                F.lit(size), F.coalesce(F.get(starts, i + 1), at + size) - at
            ),
        ),
        F.lit(0),
        lambda total, step: total + step,
    )


def measures(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, host`` and what one document alone tells, with its lines as hashes.

    Repeated windows are found in the document's own array, so nothing is shuffled:
    only texts with a repeat at all (fewer distinct window hashes than windows) have
    them sorted.
    """
    size = REPEAT_WORDS
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        text.alias("text"),
    )
    has_word = lambda line: without(line, BLANKS) != ""
    rows = (
        rows.withColumn("hashes", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))
        .withColumn("n", F.size("hashes"))
        .withColumn("lines", F.filter(F.split("text", "\n"), has_word))
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.col("n") - size),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(size)]),
    )
    rows = rows.withColumn(
        "windows", F.when(F.col("n") >= size, windows).otherwise(F.array().cast("array<bigint>"))
    )
    ordered = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn(
        "ordered",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered).otherwise(
            F.array().cast("array<struct<w:bigint,i:int>>")
        ),
    )

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.get("ordered", i)["w"] == x["w"], F.lit(False))

    repeats = F.filter("ordered", lambda x, i: same(x, i - 1) | same(x, i + 1))
    rows = rows.withColumn("starts", F.sort_array(F.transform(repeats, lambda x: x["i"])))
    return rows.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.col("n").cast("bigint").alias("n_words"),
        F.length(without(F.col("text"), BLANKS)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS)))
        .cast("bigint")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("starts"), size).cast("bigint").alias("n_repeat_words"),
        F.transform("lines", lambda line: F.xxhash64(normal_line(line))).alias("line_hashes"),
        F.transform("lines", lambda line: F.size(words_of(line))).alias("line_words"),
        *keep,
    )


def frequent_lines(
    rows: DataFrame, documents: int = LINE_DOCUMENTS, words: int = LINE_WORDS
) -> DataFrame:
    """``host, line``: of ``words`` words at least, in more than ``documents`` distinct texts of the host.

    Copies of a text count once in a host, else a much-copied document would lose
    all of its lines. The hot host is no hot key: lines are grouped by host and hash,
    and summed up before the shuffle.
    """
    first = rows.groupBy("host", "text_hash").agg(F.min("row").alias("row"))
    listed = F.filter(
        F.arrays_zip("line_hashes", "line_words"), lambda line: line["line_words"] >= words
    )
    lines = rows.join(first.select("row"), "row", "left_semi").select(
        "host", F.explode(F.array_distinct(F.transform(listed, lambda x: x["line_hashes"]))).alias("line")
    )
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > documents).select("host", "line")


def line_rules(
    docs: DataFrame,
    documents: int = LINE_DOCUMENTS,
    words: int = LINE_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: its measures, ``n_removed_lines, n_removed_words``, the verdict.

    ``base_failed``: fewer than 10 words, or more than a fifth of them in repeated
    windows. ``kept``: not that, and not depleted: without the lines its host repeats,
    10 words and half of all are left. A line of ``words`` words or more is repeated if more
    than ``documents`` distinct texts of the host have it. The host is ``source``. ``with_text`` adds
    ``clean_text``, the text without these lines.

    NULL text is empty (no words: base_failed). NULL sources are one host, as the
    empty one. Repeated rows are documents of their own with the same text; a row
    needs no doc_id. Other columns are not read.
    """
    keep = ("text",) if with_text else ()
    rows = written(
        measures(docs, keep).withColumn("row", F.monotonically_increasing_id()), "lines"
    )
    frequent = written(frequent_lines(rows, documents, words), "frequent")
    lines = rows.select(
        "row", "host", F.explode(F.arrays_zip("line_hashes", "line_words")).alias("at")
    ).select("row", "host", F.col("at.line_hashes").alias("line"), F.col("at.line_words").alias("w"))
    found = [F.count("*").alias("n_removed_lines"), F.sum("w").alias("n_removed_words")]
    if with_text:
        found.append(F.collect_set("line").alias("gone"))
    removed = lines.join(lookup_side(frequent), ["host", "line"]).groupBy("row").agg(*found)
    zero = F.lit(0).cast("bigint")
    left = F.col("n_words") - F.col("n_removed_words")
    judged = (
        rows.join(removed, "row", "left")
        .withColumn("n_removed_lines", F.coalesce("n_removed_lines", zero))
        .withColumn("n_removed_words", F.coalesce("n_removed_words", zero))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn(
            "kept",
            ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= LEFT_SHARE * F.col("n_words")),
        )
    )
    columns = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_lines", "n_removed_words",
    ]
    if not with_text:
        return judged.select(*columns)
    stays = F.filter(
        F.split("text", "\n"),
        lambda line: ~F.coalesce(
            F.array_contains("gone", F.xxhash64(normal_line(line))), F.lit(False)
        )
        | (without(line, BLANKS) == ""),
    )
    return judged.select(*columns, F.array_join(stays, "\n").alias("clean_text"))
