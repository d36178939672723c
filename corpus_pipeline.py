"""From raw documents to packed sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.llm import minhash, mixing, packing, quality, secrets
from oreflow.llm.common import SPACE_CLASS, Workspace, is_scan, row_order
from oreflow.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the cutoffs fitted on the labelled ones among them.

    Each row is judged by its own text: null and empty texts have no words and go; rows that repeat are
    kept or go alike; rows without ``doc_id`` are judged by cutoffs that others have shown to be safe.
    """
    labels = table(spark, sf_dir, "labels")
    known = quality.one_label(labels).select("doc_id")
    stats = quality.measured(docs.select("doc_id", "text", "lang").join(known, "doc_id", "left_semi"))
    cuts = quality.fitted(stats, labels)
    judged = quality.measured(docs, whole=True)
    return judged.where(quality.passes(cuts, F.col("doc.lang"))).select("doc.*")


def _numbered(docs: DataFrame, work: Workspace) -> DataFrame:
    """``docs`` with a number ``_row`` of each row that stays the same however often they are read.

    In a table that Spark wrote in one go it comes from the file's number and the row's place there; any
    other rows are written first.
    """
    names = [name.rpartition("/")[2] for name in docs.inputFiles()] if is_scan(docs) else []
    parts = [re.match(r"part-(\d+)-.*-c(\d+)\.", name) for name in names]
    if names and all(parts) and len({m.groups() for m in parts}) == len(names):
        return docs.withColumn("_row", row_order(docs))
    return work.keep(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest ``doc_id``, null last.

    Rows are told apart by a number of their own, so rows of one id with unlike texts are documents of
    their own, and rows without id are compared like others: of every group one row stays.  Rows
    without words are linked with nothing and stay.
    """
    work = Workspace(spark, "near")
    rows = _numbered(docs, work)
    found = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), work)
    groups = found.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first")
    heads = groups.groupBy("component_id").agg(first).select("first._row")
    return rows.join(heads, "_row", "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; confirmed secrets in their texts are masked, each row's own ones only."""
    work = Workspace(spark, "secrets")
    rows = _numbered(docs, work)
    found = secrets.scan(rows, work, keep=("_row",))
    return _recounted(docs, secrets.redacted(rows, found, "_row").select(*docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass of the mix over a document; the last one of a source may be cut at a word.

    A null source is a source of its own; rows without words are in no pass; rows that repeat, and
    those without ``doc_id``, are rows of their own.  Rows are in the order of the mix, by the slot that a row begins at; ``pack_sequences`` keeps it.
    """
    work = Workspace(spark, "mix")
    rows = work.keep(
        docs.withColumns(
            {"_row": F.monotonically_increasing_id(), "_size": mixing.word_count(F.col("text"))}
        ),
        "rows",
    )
    narrow = rows.select(F.col("_row").alias("row"), "doc_id", "source", F.col("_size").alias("size"))
    _, pieces = mixing.mixed(narrow, work)
    taken = pieces.groupBy("row", "pass").agg(
        F.sum("words").alias("_words"), F.min("slot").alias("_slot"), F.first("begin").alias("_begin")
    )
    taken = taken.withColumnsRenamed({"row": "_row", "pass": "_pass"})
    words = F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")
    part = F.array_join(F.slice(words, 1, F.col("_words").cast("int")), " ")
    cut = F.when(F.col("_words") < F.col("_size"), part).otherwise(F.col("text"))
    mixed = rows.join(taken, "_row").withColumn("text", cut)
    if "n_chars" in docs.columns:
        shorter = F.col("_words") < F.col("_size")
        mixed = mixed.withColumn("n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return mixed.orderBy("_slot", "source", "_pass", "_begin").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of 2048 tokens, the rows of a source in the order they come in."""
    return packing.pack(docs.withColumn("_place", row_order(docs)), Workspace(spark, "pack"), tokenizer_path(), place="_place")


def _recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` of the new texts, where the table has that column."""
    if "n_chars" not in before.columns:
        return after
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return after.withColumn("n_chars", counted).select(*before.columns)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources", source_mix),
    ("packing", pack_sequences),
]

#: Tokens, learned cutoffs and the forest are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
