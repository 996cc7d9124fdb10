"""Secret scan with an incremental blob ledger.

Every version of every text is content-addressed: its blob id is the SHA-256 of
its bytes. The ledger holds one row for each (blob, rule version) that was ever
scanned, with its findings, also when there are none. A scan takes only blobs
that have no row under the current rule version, scans each of them once however
many paths hold it, appends the result, and joins the findings back to all paths.

Findings of a blob are spans ``(kind, start, end)`` in code points, end exclusive.

Defined results: a null text is the empty text; repeated rows share a blob and all
get its findings; an empty table gives an empty table; other input columns, also
ones named like internal columns, are kept as they are.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.columns import SPANS_DDL, free_name, sha256_hex, spans_arrow, spans_column, texts
from ledgerline.session import checkpoint_dir


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost and non-overlapping; one whose ``group`` is shorter than ``least`` is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Base rules in the order in which equal starts are listed.
BASE_RULES = (
    SecretRule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds this scanner knows.
EXTRA_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
               r"(?:(?:\s*(?:Proc-Type|DEK-Info):[^\n]*)*+[^-]*+-----END [A-Z ]*PRIVATE KEY-----)?"),
    SecretRule("host_token", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + EXTRA_RULES


def rule_version(rules: tuple[SecretRule, ...]) -> str:
    """A digest of the rules: blobs scanned under other rules (or in another order) are scanned anew."""
    return sha256_hex(repr([(r.kind, r.pattern, r.group, r.least) for r in rules]))[:16]


RULE_VERSION = rule_version(RULES)

LEDGER_DDL = f"blob string, rule_version string, spans {SPANS_DDL}"


def find_secrets(text: str, rules: tuple[SecretRule, ...] = RULES) -> list[tuple[str, int, int]]:
    """Spans of all rules by start, then by the order of the rules."""
    found = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), order, m.end()))
    return [(rules[order].kind, start, end) for start, order, end in sorted(found)]


class BlobLedger:
    """The table of scanned (blob, rule version) pairs, Parquet files in a shared folder.

    One writer at a time: the anti join before each append keeps the pairs unique, so readers need no
    deduplication and their join on the blob id can be split where one blob has very many paths.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, version: str) -> DataFrame:
        """Rows of one rule version (none before the first append)."""
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        there = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)
        rows = self.spark.read.schema(LEDGER_DDL).parquet(self.path) if there else self.spark.createDataFrame([], LEDGER_DDL)
        return rows.where(F.col("rule_version") == version)

    def append(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").parquet(self.path)


def _scanner(rules: tuple[SecretRule, ...]):
    @F.arrow_udf(SPANS_DDL)
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            yield spans_arrow([find_secrets(t, rules) for t in texts(part)])
    return scan


def scan_new_blobs(versions: DataFrame, text_col: str, ledger: BlobLedger, rules: tuple[SecretRule, ...] = RULES) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks under the rules' version, each once, and append them.

    The anti join sees blob ids and texts; known blobs never reach the scanner.
    Copies meet map-side first (partial aggregation), so a text that a third of
    the rows hold is shuffled once a task.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    version = rule_version(rules)
    known = ledger.read(version)
    if not known.isEmpty():
        blobs = blobs.join(known.select("blob"), "blob", "left_anti")
    scanned = blobs.dropDuplicates(["blob"]).select(
        "blob", F.lit(version).alias("rule_version"), _scanner(rules)("text").alias("spans"))
    ledger.append(scanned)


def join_findings(versions: DataFrame, text_col: str, ledger: BlobLedger, rules: tuple[SecretRule, ...] = RULES,
                  result: str = "secrets") -> DataFrame:
    """``versions`` with the findings of each row's blob (copies of a hot text: adaptive execution splits the join)."""
    blob, spans = free_name(versions, "_blob"), free_name(versions, result)
    found = ledger.read(rule_version(rules)).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return versions.withColumn(blob, F.sha2(text, 256)).join(found, blob, "left").drop(blob)


def new_ledger(spark: SparkSession) -> BlobLedger:
    """A ledger of its own in the shared checkpoint folder."""
    return BlobLedger(spark, f"{checkpoint_dir(spark).rstrip('/')}/blob-ledger-{uuid.uuid4().hex}")


def op2_secret_scan(documents: DataFrame) -> DataFrame:
    """Secrets in every whole text of ``documents``, by way of a fresh ledger."""
    versions = documents.select("doc_id", "text")
    ledger = new_ledger(documents.sparkSession)
    scan_new_blobs(versions, "text", ledger)
    found = join_findings(versions, "text", ledger)
    base = F.filter("secrets", lambda s: s["kind"].isin(*(r.kind for r in BASE_RULES)))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(r.kind) for r in BASE_RULES),
                        F.sha2(spans_column(base), 256).alias("base_sha256"), spans_column(F.col("secrets")).alias("spans"))
