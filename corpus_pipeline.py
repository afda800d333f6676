"""Corpus pipeline: stages over ``documents``, each calling one text operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's rows as
Parquet below ``spark.checkpoint.dir`` and rereads them as the next one's ``docs``. All stages but the last
return the columns of documents.

Defined cases, in every stage: null or empty text: has no language, so the first stage drops it (given to a later stage, it is kept
as it is); null doc_id: a row like any other; repeated rows: rows of their own, of which the near-dedup stage keeps one; very
long texts: read whole; ties: see the operator each stage calls; empty table: no rows; extra columns are kept, whatever their
names; null lang or source: a value of its own in the mix.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reportkit.llm.common import read_table, written
from reportkit.llm.decontaminate import decontaminate
from reportkit.llm.langid import keep_identified
from reportkit.llm.mixing import mix
from reportkit.llm.simhash import keep_one
from reportkit.llm.suffix_dedup import remove_repeats


def language_id(spark, docs, sf_dir):
    """Documents without a language (no letters, or two languages equally near) go."""
    return keep_identified(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of linked fingerprints stays: the one with the smallest doc_id."""
    return keep_one(docs)


def suffix_array_dedup(spark, docs, sf_dir):
    """Later copies of 100-byte strings are cut out of the texts; n_chars follows the text."""
    cut = remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark, docs, sf_dir):
    """Documents are drawn so that words per source, language and topic meet the target shares; undrawn ones go."""
    return mix(docs).where("mix_copies > 0")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None  # stages train a classifier and rake weights; tests/llm compare each stage's operator with brute force


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
