"""From raw documents to packed sequences: a chain of corpus operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written
as Parquet and read again as the next stage's input. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm.common import stored
from wardflow.llm.exact_dedup import drop_copies
from wardflow.llm.language_id import drop_unidentified
from wardflow.llm.mixing import drawn_documents
from wardflow.llm.near_dedup import drop_near_copies
from wardflow.llm.packing import pack

STAGES = [
    ("language ID", lambda spark, docs, sf_dir: drop_unidentified(docs)),
    ("exact dedup", lambda spark, docs, sf_dir: drop_copies(docs)),
    ("MinHash near-dedup", lambda spark, docs, sf_dir: drop_near_copies(docs)),
    ("mixing sources to target weights", lambda spark, docs, sf_dir: drawn_documents(docs)),
    ("best-fit packing", lambda spark, docs, sf_dir: pack(docs)),
]

#: No SQL twin: SQL has neither the text model nor the tokenizer; see tests/llm for brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{i}")
    return docs
