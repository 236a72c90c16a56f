"""trendlake — daily trending-content snapshots as composable Spark DataFrame operators.

Every operator is a pure ``DataFrame -> DataFrame`` function (usable with
``df.transform``) that leaves physical planning to Catalyst/AQE.  Sub-packages:

- ``sources``   : landing-zone JSON readers/writers, curated Parquet sinks, test fixtures, models
- ``functions`` : column expressions (text, dates, numeric)
- ``operators`` : flatten, curate, features/labels, sentiment, reports, ML
- ``plans``     : SQL-text reports, the daily/backfill job plans, the driver query catalog
- ``streaming`` : incremental (micro-batch) curation of the landing zone
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so the few Python-worker
    functions (the pluggable batch scorer, the large-lexicon UDF) reach
    executors that do not have trendlake installed."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
