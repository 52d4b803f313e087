"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Every stage takes and returns the columns of ``documents`` (``text`` and ``n_chars`` as the stage leaves
them); the last returns one row of token digests per remaining document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.common import read, stored
from firmlens.llm.decontaminate import mark_contamination
from firmlens.llm.language_id import held_out, identify, learn_profiles
from firmlens.llm.line_chunks import remove_repeated_chunks
from firmlens.llm.near_dup import near_duplicates
from firmlens.llm.queries import bpe_digests

#: A document farther from every profile than this share of the largest distance is in no known language.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null texts and texts without letters go."""
    ranked = learn_profiles(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    found = identify(docs, ranked).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line chunks are cut from the texts; a document that has nothing else goes."""
    found = remove_repeated_chunks(docs).where("size(removed) = 0 OR clean <> ''")
    own = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return found.select(*[own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates.

    Of rows that repeat a doc_id with the same words, one stays; of rows without an id that hold the same
    words one, or none if a row with an id holds them. Rows without id and words all stay.
    """
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").alias("own"), F.col("text").alias("words"))
    if not docs.where("doc_id IS NULL").isEmpty():
        return _one_of_equal_words(packed, gone).select("doc.*")
    rows = packed.join(gone.withColumnRenamed("doc_id", "own"), "own", "left_anti")
    # only the rows that repeat an id are looked at again: mostly few
    repeated = stored(docs.groupBy(F.col("doc_id").alias("own")).count().where("count > 1").select("own"), "near_dedup_repeated")
    single = rows.join(repeated, "own", "left_anti").select("doc")
    again = rows.join(repeated, "own", "left_semi").select("doc", "own", _mark(F.col("words")).alias("mark"))
    return single.unionByName(again.groupBy("own", "mark").agg(F.min("doc").alias("doc")).select("doc")).select("doc.*")


def _one_of_equal_words(packed: DataFrame, gone: DataFrame) -> DataFrame:
    """The same where ids are missing: equal words are looked for among all rows."""
    marked = packed.withColumn("mark", _mark(F.col("words"))).drop("words")
    marked = marked.withColumn("mark", F.when(F.col("own").isNotNull() | (F.length("mark") > 16), F.substring("mark", 1, 16)))
    # hashes of rows that occur more than once: mostly few, so that no text is shuffled
    each = marked.where("mark IS NOT NULL").groupBy("own", "mark").count()
    repeated = stored(
        each.groupBy("mark").agg(F.max("count").alias("most"), F.expr("bool_or(own IS NULL)").alias("loose"), F.expr("bool_or(own IS NOT NULL)").alias("named"))
        .where("most > 1 OR (loose AND named)").select("mark", "named"),
        "near_dedup_repeated",
    )
    rows = marked.join(gone.withColumnRenamed("doc_id", "own"), "own", "left_anti")
    single = rows.join(repeated, "mark", "left_anti").select("doc")
    one = rows.join(repeated, "mark").where("own IS NOT NULL OR NOT named").groupBy("own", "mark").agg(F.min("doc").alias("doc")).select("doc")
    return single.unionByName(one)


def _mark(text: Column) -> Column:
    """A hash of the text's words (16 bytes and one more), or of a text without words (16 bytes)."""
    lower = F.translate(text.cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(lower, r"[ \t\r\n\f\x0B]+", " "))
    empty = F.concat(F.when(text.isNull(), "null").otherwise("text"), F.coalesce(text.cast("string"), F.lit("")))
    return F.when(words != "", F.concat(F.unhex(F.md5(words.cast("binary"))), F.unhex(F.lit("01")))).otherwise(F.unhex(F.md5(empty.cast("binary"))))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return mark_contamination(docs, read(spark, sf_dir, "benchmark")).where(F.size("hit_items") == 0).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe_digests(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("bpe", encode),
]

#: Rank-order profiles and byte-level BPE have no SQL form; tests/llm holds every stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
