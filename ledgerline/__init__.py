"""ledgerline — finance, retention and churn analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from
Spark's own expressions, so Catalyst plans it and the work runs distributed.

Sub-packages:

* ``functions`` — Column helpers (periods, date dimensions, text cleaning,
  money rounding).
* ``operators`` — reusable relational operators (date spines, latest row per
  key, aggregate-and-join-back benchmarks, skew-safe outer joins, the
  active-window counter, the e-mail bridge, sink-side global sort).
* ``sources`` — table loading, the role tables derived from the test parquet,
  and layer sinks.
* ``plans`` — the composite products (budget variance, fee transactions,
  student activity/activation/daily series, programme revenue, churn) and the
  query catalog.
* ``streaming`` — the fee-transaction layer as a Structured Streaming job.
* ``jobs`` — spark-submit entry point writing every report layer.
* ``oracle`` — independent DuckDB SQL for every catalog key (test oracle).
"""

__version__ = "0.1.0"
