"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing and sharding over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver, or ``run``, writes it and hands the written
copy to the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import flow_reshard, outlier_rules, prefix_decontam, source_mix, tensor_dedup
from lectern.llm.common import table, written

#: Near-duplicates in the pipeline: five-word shingles, similarity 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distances reject go."""
    return outlier_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return tensor_dedup.drop_near_duplicates(docs, SHINGLE, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more repeats benchmark windows go."""
    return prefix_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times."""
    mixed = source_mix.mix(source_mix.with_quality_weights(docs, table(spark, sf_dir, "labels")), F.col("quality weight"))
    copies = mixed.filter("copies > 0").withColumn("copy number", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents moved from 16 shards into 24 of equal bytes: (doc_id, size, text_crc32, law, shard, slot, grown_shard)
    read back from the shards."""
    return flow_reshard.resharded(spark, docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("source_mixing", source_mixing), ("sharding", sharding)]
#: Robust estimates, minhash and the flow are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
