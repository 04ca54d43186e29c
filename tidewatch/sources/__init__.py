"""Sources: raw lines, Kafka and test tables -> typed record frames."""

from tidewatch.sources.decode import DECODERS
from tidewatch.sources.text import read_lines, read_records, read_socket

__all__ = ["DECODERS", "read_lines", "read_records", "read_socket"]
