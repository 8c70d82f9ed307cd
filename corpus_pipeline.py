"""The corpus pipeline: five stages from raw documents to a weighted mix.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and is written as Parquet before
the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.llm import decontaminate, mixing, occurrence_join, quality_fm, secret_scan, simhash
from stratica.llm.common import spare, written
from stratica.llm.queries import QUALITY_CUT
from stratica.proofs.registry import table
from stratica.session import prepare

#: Near-duplicates: words of a shingle, and the least similarity as a fraction.
NEAR_WORDS, NEAR_LEAST = 5, (4, 5)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    score = spare(docs, "score")
    labels = table(prepare(spark), sf_dir, "labels")
    return quality_fm.quality(docs, labels, score).where(F.col(score) >= QUALITY_CUT).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by SimHash: fingerprints within its radius are linked.

    Most pairs of a five-word similarity of 0.8 or more lie beyond a radius that buckets can serve; a join finds these,
    and their links are added. Texts without words, or none, are copies of each other."""
    prepare(spark)
    similar = written(occurrence_join.grouped(docs, NEAR_WORDS, NEAR_LEAST), "near-groups")
    return simhash.one_of_each(docs, occurrence_join.key_of(F.col("text")), similar)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds."""
    prepare(spark)
    return secret_scan.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix: size and target of the source, and the words taken, repeats counted."""
    prepare(spark)
    name = spare(docs, "mix")
    out = mixing.mixed(docs, mixing.plan(docs), name).where(F.col(name)["taken"] > 0)
    facts = ("size", "source_size", "target", "taken")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *(F.col(name)[f].alias(spare(docs, f)) for f in facts))


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("source mixing", mixture),
]

#: Classifier, fingerprints and rules have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
