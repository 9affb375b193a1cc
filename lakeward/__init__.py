"""lakeward: a Spark-native medallion and data-quality engine.

Landed XML/JSON documents are decoded into tidy rows, landing CSV is ingested
incrementally into bronze Parquet tables (malformed records kept and flagged),
silver tables keep one latest-fetch-wins row per business key, named row
expectations are counted on every table, and one idempotent job consolidates
the per-pipeline pass/fail counters into a data-quality history table.

Everything is ordinary DataFrame / SQL / Structured Streaming work; see
README.md for the module map and the scale notes.
"""

__version__ = "0.1.0"
