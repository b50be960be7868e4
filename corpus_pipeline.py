"""A training corpus from raw documents: five stages, each an operator of ``tributary.llm``.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's documents. All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm.common import materialise, read_table, spread
from tributary.llm.decontaminate import drop_contaminated
from tributary.llm.packing import pack_documents
from tributary.llm.quality import drop_poor
from tributary.llm.simhash import drop_near_duplicates
from tributary.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the model of trusted text finds too strange or too repetitive, in their language. Null and empty texts, repeats and empty tables: as ``quality.classify`` has them."""
    return drop_poor(docs, read_table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a score of 0.3 or more. Null and empty texts have no clause and stay; of rows that repeat a text all stay or all go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group at a similarity of 0.8 or more: the smallest id. Null and empty texts are alike, so one of them stays."""
    return drop_near_duplicates(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold four fifths or more of a benchmark item. Null and empty texts hold nothing and stay."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), words=5, containment=0.8)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents, packed to sequences of 2,048 tokens; a null or empty text is one piece of the end id."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: The models of the first two stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
