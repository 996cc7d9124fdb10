"""Structured Streaming variants of the report layers."""

from ledgerline.streaming.fee_stream import fee_transactions_stream, start_layer_sink  # noqa: F401
