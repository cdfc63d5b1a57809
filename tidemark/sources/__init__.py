"""Sources: delimited record files, access-log lines, line streams, and adapters from the driver tables."""

from tidemark.sources.records import read_records, read_records_stream, with_arrival
from tidemark.sources.access_log import parse_access_log, read_access_log
from tidemark.sources.lines import line_stream, publish_lines, topic_lines
from tidemark.sources import adapters

__all__ = [
    "read_records", "read_records_stream", "with_arrival", "parse_access_log", "read_access_log",
    "line_stream", "publish_lines", "topic_lines", "adapters",
]
