"""riskframe — relational credit-risk analytics expressed as Spark DataFrame plans.

Layout
------
sources/    table catalog, CSV/Parquet scans with the missing-token rules, staged sinks,
            model persistence, and the fixture views that map the driver tables onto the
            credit schemas.
functions/  column-expression helpers (null rules, rounding) and the bucketed prefix sum
            that gives exact ranks and quantiles without a single-partition window.
operators/  cleaning, feature building, profiling, preparation, models, metrics,
            segmentation, interpretation and scoring.
plans/      composed plans (feature matrix, end-to-end build), plan checks, and the
            registry of named queries used by ``__spark_entry__``.
streaming/  batch scoring applied to a streaming source.
"""

__all__ = ["session"]
