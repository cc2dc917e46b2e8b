"""A training corpus from raw documents: language ID, quality, near-duplicates,
source mix, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its
predecessor kept, written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.

Cases (each stage): null and empty texts go with the language stage, which
cannot place them; where a stage meets them itself it treats them as its
operator says; repeated rows are kept or dropped alike, and the near-duplicate
stage leaves one; an empty table passes through as an empty one; extra columns
are carried along whatever their names.

No SQL expresses the trained stages, so ORACLE_SQL is None and the tests hold
each stage against its operator and a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatcast.llm import langid, mixing, packing, quality, simhash
from seatcast.llm.common import fresh, stage, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    p = fresh(docs, "prediction")
    judged = docs.withColumn(p, langid.predict(docs, langid.train(docs), docs["text"]))
    return judged.where(F.col(p)["accepted"]).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs, model, docs["text"]) >= quality.ACCEPT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece in the training sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
