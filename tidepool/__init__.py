"""tidepool: an ELT, mart, data-quality and reporting layer expressed with Spark's
DataFrame, SQL and Structured Streaming APIs.

Sub-packages
------------
sources     readers for files, JSON documents, JDBC tables and landed API pages
functions   Column helpers (casts, best-effort datetime parsing)
operators   loads (append / replace / merge / insert-ignore / incremental),
            normalization (names, flattening, child tables) and data tests
plans       staging models, the customer_activity mart, report cards, ad-hoc SQL
streaming   file-landing ingestion with an availableNow trigger
"""

__version__ = "0.1.0"
