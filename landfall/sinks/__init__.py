"""Writers: code-list CSV, partitioned Parquet, deliveries of the lake, dated loads with commits, and full-refresh tables kept as snapshots."""

from landfall.sinks.files import write_code_list, write_parts
from landfall.sinks.lake import write_delivery as write_lake
from landfall.sinks.snapshots import read_snapshot, retire, write_snapshot

__all__ = ["read_snapshot", "retire", "write_code_list", "write_lake", "write_parts", "write_snapshot"]
