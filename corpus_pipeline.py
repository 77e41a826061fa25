"""The corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from tradewind.llm import byte_bpe, mixing, ngram_join, quality_rules, suffix_dedup
from tradewind.llm.common import Scratch, table

STAGES = [
    ("quality rules", quality_rules.stage),
    ("n-gram Jaccard join", ngram_join.stage),
    ("suffix-array dedup", suffix_dedup.stage),
    ("mixing sources", mixing.stage),
    ("byte-pair encoding", byte_bpe.stage),
]

#: Suffix-array dedup and byte-pair encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.put(f"stage-{k}", stage(spark, docs, sf_dir))
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
