"""The analyses as plans: over the driver tables (``jobs``), over record files (``files``), the query
registry and the DuckDB reference SQL (``oracles``)."""
