"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.  Two stages are models or approximate in
their candidates, so SQL cannot express the run (``ORACLE_SQL`` is None).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.minhash_dedup import near_duplicates
from tessera.llm.mixing import mix_sources
from tessera.llm.quality import THRESHOLD, fit_quality, score_quality
from tessera.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose quality score reaches the threshold."""
    net = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_quality(docs, net).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated lines; a document that lost all its lines of ten characters and more goes if it is a copy or blank now.

    A copy has the whole text of a smaller id; other documents keep their
    shorter lines.  ``n_chars`` is the length of the new text.
    """
    marked = docs.withColumn("whole", F.unhex(F.md5(F.col("text").cast("binary"))))
    first = marked.groupBy("whole").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("whole", "first")
    first = store(first, "line-first")  # a row per repeated text, however many copies it has
    copies = marked.select("doc_id", "whole").join(first, "whole").where("doc_id > first").select("doc_id", "whole")
    copies = store(copies, "line-copies").distinct().withColumn("copy", F.lit(True))
    copies = store(copies, "line-copy-ids")  # of known size, so that a short list is not joined by a shuffle of the texts
    out = dedup_lines(marked, keep=("lang", "source", "whole")).join(copies, ["doc_id", "whole"], "left")
    out = out.where(~F.col("emptied") | (F.col("copy").isNull() & F.col("text").rlike(r"[^ \t\n\x0B\f\r]")))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near-duplicates (five-word shingles, similarity 0.8): the smallest doc_id.

    Rows are told apart by id and text, so another text under the id of a copy
    stays; rows alike in both are one document.  Rows without id all stay.
    """
    near = store(near_duplicates(docs, shingle_words=5, percent=80, mark=True).select("doc_id", "mark", "kept"), "near-duplicates")
    marked = docs.withColumn("mark", F.xxhash64("text"))
    # Stored, so that their size is known and the texts are not shuffled for a short list.
    gone = store(near.where("not kept").select("doc_id", "mark").distinct(), "near-gone")
    left = marked.join(gone, ["doc_id", "mark"], "left_anti")
    again = store(near.where("kept and doc_id is not null").groupBy("doc_id", "mark").count().where("count > 1").drop("count"), "near-again")
    if not again.isEmpty():
        once = left.join(again, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
        left = left.join(again, ["doc_id", "mark"], "left_anti").unionByName(once)
    return left.select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold ten words in a row (or a whole shorter item) of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources: every document at least once, small sources repeated up to twice."""
    mixed = mix_sources(docs, keep=("text", "lang", "n_chars"))
    return mixed.select(*COLUMNS, "n_tokens", "pass", "block", "slot")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
