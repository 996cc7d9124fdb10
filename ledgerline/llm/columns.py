"""Small DataFrame helpers of the operators."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until ``df`` has no such column (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null is the empty text."""
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Each text of an Arrow column; null is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def spans_text(spans, kinds: dict[str, int] | None = None):
    """``kind:start:end`` of each span by start, then kind as listed, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[1], kinds[s[0]], s[2])) if kinds else spans
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def spans_column(spans):
    """SQL form of :func:`spans_text` for an ordered array of (kind, start, end)."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


#: DDL of an array of found spans: code points, end exclusive.
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def spans_arrow(found: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found], SPANS_ARROW)
