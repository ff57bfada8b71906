"""The corpus pipeline: five stages, each on all that the one before kept.

quality rules -> near duplicates -> benchmark decontamination -> personal data -> mix.
Every stage is written as Parquet in the shared folder and read again, so a lost
executor costs at most the stage at work.  All stages but the last return the columns
of ``documents``; the last adds block, slot and position of the mix.

Defined results: a null text counts as empty and fails the quality rules; what each
stage does with ties, repeated rows and clashing names is in its operator's module; an
empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import decontam, mixing, pii, quality_bands, simhash
from trawl.llm.common import free_name, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the compression bands keep."""
    text = free_name(docs, "judged")
    judged = quality_bands.compression_bands(docs.select(F.struct(*docs.columns).alias("row"), docs["text"].alias(text)), text)
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their place in the mix of sources."""
    return mixing.mix(docs, mixing.TARGET_PARTS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: SQL has no zstandard, so the first stage cannot be stated in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
