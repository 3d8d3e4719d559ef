"""moneytrail: campaign-finance analytics on Spark.

Packages: ``sources`` (raw layouts, scans, sinks, test-table mapping),
``operators`` (curated tables, views, reports, profile, ranking, semantic
measures, chart angles, audits), ``functions`` (typing, formatting, constants,
distributed ranks), ``plans`` (session, joins, landed store, user entry points),
``streaming`` (snapshot refresh), ``oracle`` (DuckDB restatement for checks).
"""

__version__ = "0.1.0"
