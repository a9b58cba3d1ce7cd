"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's result to the shared folder and
reads it again for the next one, so a lost executor costs no more than a stage.

Rows that share one id are one document: they stay or go together. Rows without an id are never near
copies or contaminated; rows without text or letters go in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import decontam, packing, partenum, ppm, skipcrf
from tapewright.llm.common import anti_join, materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: No SQL states the stages; they are tested against brute-force versions.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a learnt language go on; a missing language is filled in.

    Rejected: no letters, or a posterior below one half.
    """
    found = ppm.predict(docs.select(*COLUMNS), ppm.fit(docs), carry=COLUMNS)
    kept = found.where((F.col("lang_pred") != ppm.UNKNOWN) & (F.col("score") >= 0.5))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the document with the smallest id goes on."""
    grouped = partenum.similar_components(docs, words=5, percent=80)
    copies = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    return anti_join(docs.select(*COLUMNS), copies)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontam.contained(docs, table(spark, sf_dir, "benchmark"))
    return anti_join(docs.select(*COLUMNS), found.select("doc_id").distinct())


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    found = skipcrf.find(docs, skipcrf.fit(docs), carry=("doc_id", "lang", "source"), mask=True)
    return found.select(
        "doc_id", F.col("masked").alias("text"), "lang", "source", F.length("masked").cast("long").alias("n_chars")
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
