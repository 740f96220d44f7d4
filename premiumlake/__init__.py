"""premiumlake: insurance premium marts, history, data quality and reports on Spark DataFrames.

Entry points: ``operators.ingest`` (bronze, silver), ``operators.party_marts`` and
``operators.customer_marts`` (the gold marts), ``operators.spine`` (daily activity),
``operators.history`` / ``operators.state`` (SCD2, keyed loads), ``operators.quality`` (declared
tests, audits, profile), ``operators.reports`` and ``operators.guarded_sql``, ``plans.build``
(layered build) and ``streaming.incremental``. ``session`` holds the required settings.
"""

__version__ = "0.1.0"
