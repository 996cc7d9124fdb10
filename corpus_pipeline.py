"""Training-data pipeline over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with all
their columns; each result is written as Parquet and read again as the next stage's
``docs``. The last stage adds what the mix takes of each document.

Defined results: rows with null or empty text pass the filters (they hold nothing to
reject) and take 0 words; repeated rows go down to one in the second stage unless
they have no words; an empty table passes through; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name
from ledgerline.llm.decontamination import contaminated, find_contamination
from ledgerline.llm.jaccard_join import JoinSpec, keep_one_of_each
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.secret_scan import join_findings, new_ledger, scan_new_blobs
from ledgerline.llm.toxicity import label_chain, score_toxicity, train_chain
from ledgerline.sources.sinks import materialize
from ledgerline.sources.tables import read_table

#: Near duplicates of the pipeline: five-word shingles, similarity 0.8 or more.
NEAR = JoinSpec(words=5, percent=80)


def _same_columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic (operator 3)."""
    chain = train_chain(docs, "text", "doc_id", read_table(spark, sf_dir, "labels"), label_chain())
    result = free_name(docs, "toxicity")
    scored = score_toxicity(docs, "text", chain, result)
    return _same_columns(scored.where(F.col(result)["toxic"] < chain.thresholds["toxic"]), docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents (operator 9)."""
    return keep_one_of_each(docs, "text", "doc_id", NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window (operator 5)."""
    result = free_name(docs, "contamination")
    found = find_contamination(docs, "text", read_table(spark, sf_dir, "benchmark"), result=result)
    return _same_columns(found.where(~contaminated(result)), docs)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which the scanner finds no secret (operator 2)."""
    result, ledger = free_name(docs, "secrets"), new_ledger(spark)
    scan_new_blobs(docs, "text", ledger)
    found = join_findings(docs, "text", ledger, result=result)
    return _same_columns(found.where(F.size(result) == 0), docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, source_size, target and the words the mix takes of each (operator 6)."""
    result = free_name(docs, "mix")
    mixed = mix_sources(docs, "text", "source", "doc_id", result=result)
    added = {c: free_name(docs, c) for c in ("size", "source_size", "target", "taken")}
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns), *(F.col(result)[c].alias(name) for c, name in added.items()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", drop_secrets),
    ("mixing", mix_to_targets),
]

#: The classifier has no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
