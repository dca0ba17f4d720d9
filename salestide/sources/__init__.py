"""Sources and sinks: file relations, JSON topic streams, result files."""

from salestide.sources.files import read_relation, rejected_rows
from salestide.sources.results import read_result, read_summary
from salestide.sources.sinks import write_result
from salestide.sources.stream import decode, kafka_messages, rejected, route, to_messages

__all__ = ["read_relation", "rejected_rows", "read_result", "read_summary",
           "write_result", "decode", "rejected", "kafka_messages", "route", "to_messages"]
