"""Training corpus in five stages over ``documents``: low quality out, one of
every group of near-duplicates, benchmark passages out, sources mixed to target
weights, rows placed into shards.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept. ``run`` writes each stage's rows as Parquet to the shared folder
and reads them again, so a lost executor costs one stage's tasks at most.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns
are handled as the operators' docstrings say: rows without an id pass
near-duplicates, rows without words are never taken by the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.llm import decontamination, mixing, near_dups, quality, resharding
from cellfold.llm.queries import NEW_SHARDS, OLD_SHARDS, byte_size, held_out, table
from cellfold.llm.words import n_words
from cellfold.session import Stages


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, gives 0.5 or more."""
    forest = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held_out("doc_id"))
    return quality.score(docs, forest, to="__score").filter("__score >= 0.5").drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every component of links."""
    return near_dups.keep_first(docs, Stages(spark))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated as often as their source's target asks, in the
    order of the output shards and shuffled within them."""
    whole = docs.select(F.struct("*").alias("doc"))  # columns of any name stay as they are
    size = n_words(F.col("doc.text"))
    mixed = mixing.mix_sources(whole, Stages(spark), source=F.col("doc.source"), size=size, key=F.col("doc.doc_id"))
    return mixing.mixed_rows(mixed, size=size).select("doc.*")


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``shard`` and ``slot`` of every row, moving the fewest bytes out of the
    key shards in which the rows lie."""
    return resharding.reshard(docs, old_shard=F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)),
                              size=byte_size(F.col("text")), key=F.col("doc_id"), n_new=NEW_SHARDS)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("mixing", mix), ("sharding", place)]

ORACLE_SQL = None  # tests/llm/test_pipeline.py holds every stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        own = Stages(spark)
        docs = own.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:  # the rows of the stage before have been read
            before.release()
        before = own
    return docs
