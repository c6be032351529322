"""From raw documents to packed training sequences, in five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
back as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import decontaminate, jaccard, packing, suffixes, toxicity
from wardline.llm.common import Scratch, prepare
from wardline.llm.suffixes import PASSAGE_GRAM, PASSAGE_WORDS
from wardline.llm.tokens import default_path, definition


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels, Scratch(prepare(spark), "toxicity"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard.one_of_each(docs, Scratch(prepare(spark), "jaccard"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that lie in a run of ``PASSAGE_WORDS`` words which also starts elsewhere."""
    scratch = Scratch(prepare(spark), "suffixes")
    return suffixes.cleaned(docs, scratch, length=PASSAGE_WORDS, gram=PASSAGE_GRAM, unit=suffixes.WORD_UNITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; an id with one goes with all its rows."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, items).select("doc_id").distinct().withColumnRenamed("doc_id", "found")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["found"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pieces(packing.pack(docs, Scratch(prepare(spark), "packing"), definition(default_path())))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard join", drop_near_duplicates),
    ("suffix array", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Models, tokens and byte ranges are beyond SQL; tests hold each stage against a plain version, toxicity against its scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
