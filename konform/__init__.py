"""konform: conform and synchronise business tables with Spark DataFrames.

Subpackages
-----------
sources     landed payload readers (JSON envelopes, XML feeds, CSV) and control scans
functions   Column builders: type coercion, incremental predicates, run-log text
operators   DataFrame -> DataFrame operators: column mapping, line flattening, writes
plans       sync planning (modes, work lists), write-rule choice, watermark/run log, table sync
streaming   the same table sync driven by a file stream (availableNow + foreachBatch)
catalogue   the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
