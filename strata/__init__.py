"""strata: a Spark-native medallion (bronze / silver / gold) analytics library.

Change capture, batch ingest, silver and gold models, reports, data-quality
checks and reconciliation, all as DataFrame -> DataFrame functions planned by
Catalyst. See README.md for the operator map.
"""

__version__ = "0.1.0"
