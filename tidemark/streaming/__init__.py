"""Streaming forms: watermarked aggregations (``aggregations``), transformWithState processors
(``processors``), and streaming jobs plus foreachBatch writers (``jobs``)."""
