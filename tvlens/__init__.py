"""tvlens: viewing analytics for a streaming platform, written as Spark jobs.

Layout
------
functions/  Column helpers that fix the semantics of the source dialect
            (weekday numbering, calendar-day gaps, NULL-strict LEAST, ...).
sources/    Readers for the parquet inputs, the viewing-log, CRM and partner
            views derived from them, and sinks (overwrite / append once /
            partitioned / bucketed / view / bounded fetch).
operators/  Reusable table operators: joins (NULL keys spread, one-row
            relations, one-pass grouped values, cyclic lookup), numbering (row
            ordinals, dense index, samples, caps), labels (quotas, fractions,
            NULL and near-duplicate injection), row expansion, overlap.
plans/      The analytics themselves: customer 360, programme, peak-time and
            device analytics, daily summary, top-k and serving queries, SQL
            views, the query registry and its DuckDB oracle.
streaming/  Structured Streaming refresh of the materialised daily summary.

Every public function takes and returns lazy DataFrames; reference dates are
arguments, never CURRENT_DATE, so results are reproducible.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming", "session"]
