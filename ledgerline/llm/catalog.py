"""The ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    decontamination,
    html_text,
    jaccard_join,
    merkle,
    mixing,
    pii,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    whitening,
)
from ledgerline.sources.tables import read_table


def _over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(read_table(spark, sf_dir, t) for t in tables))
    query.__name__, query.__doc__ = operator.__name__, operator.__doc__
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        _over(url_filter.op1_url_filter, "pages"),
        _over(secret_scan.op2_secret_scan, "documents"),
        _over(toxicity.op3_toxicity, "documents", "labels"),
        _over(pii.op4_pii, "documents"),
        _over(decontamination.op5_decontamination, "documents", "benchmark"),
        _over(mixing.op6_source_mix, "documents"),
        _over(html_text.op7_html_text, "pages"),
        _over(substring_dedup.op8_substring_dedup, "documents"),
        _over(jaccard_join.op9_jaccard_join, "documents"),
        _over(quality_rules.op10_quality_rules, "documents"),
        _over(whitening.op11_embedding_whitening, "embeddings"),
        _over(merkle.op12_merkle_manifest, "documents"),
        _over(simhash.op13_simhash, "documents"),
    )
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express on whole tables."""
    return {"op1_url_filter": url_filter.OP1_SQL, "op5_decontamination": decontamination.OP5_SQL,
            "op6_source_mix": mixing.OP6_SQL, "op8_substring_dedup": substring_dedup.OP8_SQL,
            "op9_jaccard_join": jaccard_join.OP9_SQL, "op12_merkle_manifest": merkle.OP12_SQL}
