"""Monthly customer propensity engine written as Spark DataFrame operations.

Layout:
    sources/    typed scans, CSV staging, table sink, test fixtures
    functions/  calendar arithmetic, column helpers, distributed ranking
    operators/  features, assembly, labels, customers, profile, evaluation, model
    plans/      end-to-end jobs (train, score, report) and the query catalog
    streaming/  incremental daily ingest
"""

__all__ = ["session"]
