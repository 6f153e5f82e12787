"""shoplens: customer-behaviour analytics on shop data, built on Spark DataFrames.

Layout
------
- ``sources``   readers (strict NDJSON, table scans, JDBC option builder, fixture views)
- ``sinks``     writers (parquet/JSON/CSV export, topic messages, target table)
- ``functions`` column-expression helpers (PII, time, text)
- ``operators`` DataFrame -> DataFrame operators (aggregates, flags, cleaning, upsert, ...)
- ``plans``     whole jobs composed from operators, plus the query registry
- ``streaming`` Structured Streaming versions of the cleaning and dedup stages
"""

__version__ = "0.1.0"
