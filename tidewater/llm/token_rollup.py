"""Token totals by source, language and tokenizer version, kept up to date by signed changes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm.common import in_python, words_of, written
from tidewater.llm.packing import encoder, vocabulary_path
from tidewater.operators.scale import lookup_side
from tidewater.sinks.batches import BatchTable

KEY = ("source", "lang", "tokenizer")
BPE, WORDS = "byte_bpe_50k", "words_1"


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens``: two rows per document, one per version.

    ``byte_bpe_50k`` counts ids of the vocabulary file, ``words_1`` runs of non-blanks.
    NULL text has none of either.
    """
    path = vocabulary or vocabulary_path()

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            ids = encoder(path).encode([(text or b"").decode() for text in batch["text"]])
            yield batch | {"bpe": [len(one) // 4 for one in ids]}

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.col("text").cast("string"),
        F.size(words_of(F.col("text").cast("string"))).cast("bigint").alias("words"),
    )
    names = "doc_id bigint, source string, lang string, words bigint, bpe bigint"
    both = F.array(
        F.struct(F.lit(BPE).alias("tokenizer"), F.col("bpe").alias("tokens")),
        F.struct(F.lit(WORDS).alias("tokenizer"), F.col("words").alias("tokens")),
    )
    return (
        in_python(rows, work, names)
        .withColumn("count", F.explode(both))
        .select("doc_id", "source", "lang", "count.*")
    )


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEY, F.lit(1).alias("documents"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEY, F.lit(-1).alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed counts of the same documents: what went and what came, also under other keys."""
    return deletes(old).unionByName(inserts(new))


class TokenRollup:
    """Additive totals in the shared folder: one folder of summed changes per batch.

    A batch is committed by its folder's success mark. Committing it again, after a
    lost driver or by a repeated message, finds the mark and changes nothing; a batch
    that broke off is written anew. Totals are the sum of all batches, so batches may come
    in any order. The changes of a batch are summed up in every task before the
    shuffle: a source with a third of all rows costs one row per task and key.
    """

    def __init__(self, path: str):
        self.batches = BatchTable(
            path, "source string, lang string, tokenizer string, documents bigint, tokens bigint"
        )

    def commit(self, batch_id: int, changes: DataFrame) -> None:
        """Record a batch of signed changes (``source, lang, tokenizer, documents, tokens``)."""
        self.batches.add(batch_id, self._summed(changes))

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Fold all batches up to this one into one folder; later commits of them are no-ops
        for the totals, as only newer batches are added to it."""
        self.batches.replace(batch_id, self._summed(self.batches.before(spark, batch_id + 1)))

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row per key that still has documents or tokens."""
        return self._summed(self.batches.latest(spark)).where("documents <> 0 or tokens <> 0")

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEY).agg(
            F.sum("documents").cast("bigint").alias("documents"),
            F.sum("tokens").cast("bigint").alias("tokens"),
        )


def _counted(docs: DataFrame) -> DataFrame:
    """Per row: its key, a hash of its text, counts of it, and of it without repeated lines.

    The latter are NULL if no line repeats. A table with a number for each row is written, so
    that rows that share a doc_id or have none can be told apart.
    """
    path = vocabulary_path()

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        sizes = lambda texts: [len(ids) // 4 for ids in encoder(path).encode(texts)]
        for batch in batches:
            changed = [at for at, text in enumerate(batch["revised"]) if text is not None]
            again: list[int | None] = [None] * len(batch["text"])
            for at, n in zip(changed, sizes([batch["revised"][at].decode() for at in changed])):
                again[at] = n
            yield batch | {"bpe": sizes([text.decode() for text in batch["text"]]), "new_bpe": again}

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split("text", "\n")
    revised = F.when(
        F.size(F.array_distinct(lines)) < F.size(lines), F.array_join(F.array_distinct(lines), "\n")
    )
    rows = (
        docs.select(
            F.col("doc_id").cast("bigint"),
            F.col("source").cast("string"),
            F.col("lang").cast("string"),
            text.alias("text"),
        )
        .withColumn("hash", F.xxhash64("text"))
        .withColumn("words", F.size(words_of(F.col("text"))).cast("bigint"))
        .withColumn("revised", revised)
        .withColumn(
            "new_words", F.when(F.col("revised").isNotNull(), F.size(words_of(F.col("revised")))).cast("bigint")
        )
    )
    names = (
        "doc_id bigint, source string, lang string, hash bigint, "
        "words bigint, bpe bigint, new_words bigint, new_bpe bigint"
    )
    counted = in_python(rows, work, names)
    return written(counted.withColumn("row", F.monotonically_increasing_id()), "counts")


def _by_tokenizer(rows: DataFrame, bpe: str, words: str) -> DataFrame:
    both = F.array(
        F.struct(F.lit(BPE).alias("tokenizer"), F.col(bpe).alias("tokens")),
        F.struct(F.lit(WORDS).alias("tokenizer"), F.col(words).alias("tokens")),
    )
    return rows.withColumn("count", F.explode(both)).select("source", "lang", "count.*")


def maintained_totals(docs: DataFrame, path: str) -> DataFrame:
    """The totals after three batches of changes, two of them sent twice.

    All documents are inserted; copies of a text with a smaller doc_id are deleted; the
    rest of those that repeat a line are revised: counted anew without the repeats.
    Decisions are by row, whatever other rows have its doc_id or have none.
    NULL source or language is a key of its own; NULL texts count as empty and as copies
    of each other; a copy without doc_id goes if one has a doc_id, and of copies with one
    doc_id, or that all have none, all stay. Other columns are not read.
    """
    spark = docs.sparkSession
    rollup = TokenRollup(path)
    rows = _counted(docs)
    rollup.commit(0, inserts(_by_tokenizer(rows, "bpe", "words")))

    least = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    firsts = written(
        least.where("n > 1").where("doc_id is not null").select("hash", F.col("doc_id").alias("first")),
        "firsts",
    )
    copies = rows.select("row", "doc_id", "hash").join(lookup_side(firsts), "hash")
    gone = written(
        copies.where(~F.coalesce(F.col("doc_id") <= F.col("first"), F.lit(False))).select("row"), "gone"
    )
    deleted = rows.join(lookup_side(gone), "row", "left_semi")
    rollup.commit(1, deletes(_by_tokenizer(deleted, "bpe", "words")))

    revised = rows.where("new_bpe is not null").join(lookup_side(gone), "row", "left_anti")
    old, new = _by_tokenizer(revised, "bpe", "words"), _by_tokenizer(revised, "new_bpe", "new_words")
    rollup.commit(2, revisions(old, new))
    for batch_id, changes in (
        (0, inserts(_by_tokenizer(rows, "bpe", "words"))),
        (2, revisions(old, new)),
    ):
        rollup.commit(batch_id, changes)
    return rollup.totals(spark)
