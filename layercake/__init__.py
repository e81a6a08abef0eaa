"""layercake: a PySpark toolkit for batch lakehouse work.

Typed/untyped CSV, JDBC, catalog-table and newest-file sources; PII drop and
SHA-256 hashing; recodes, blank fallbacks, left-outer and first-match lookups;
config-driven column mapping; one-pass status reports; dated bronze/silver/gold
layers, partitioned tables (overwrite, insert-only merge, schema and partition
evolution), per-key exports and JDBC appends.  Every operator is a function
from DataFrame to DataFrame built on Spark's own functions.
"""

__version__ = "0.1.0"
