"""gridpanel: hourly prosumer forecasting panels on Spark.

Pure functions ``DataFrame -> DataFrame`` grouped by concern:

- ``sources``    table loading, cleaning, time spines, sinks
- ``functions``  column expressions (calendar, encodings, numeric, time zones, solar position)
- ``operators``  joins, lags, enrichment, normalisation, quality checks, profiles, models
- ``plans``      fixture panels, composed feature pipelines, backtests, the query catalog
- ``streaming``  Structured Streaming forms of history, block replay and live lags
"""

__version__ = "0.1.0"
