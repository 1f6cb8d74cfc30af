"""tiermill: a medallion (raw -> staging/quarantine -> marts) pipeline on Spark.

Every layer is a DataFrame transformation; Catalyst plans the work and the
parquet scans carry the pushed filters and pruned columns.
"""

__all__ = ["session", "schemas"]
