from funnelspark.sources.readers import PartitionedTable, flatten_records, latest_partition, open_table, read_table, scan_hours
from funnelspark.sources.schemas import SCHEMAS
from funnelspark.sources.sinks import intermediates, recover, shared_folder, via_shared_table, write_hour, write_hours, write_once

__all__ = [
    "SCHEMAS",
    "PartitionedTable",
    "flatten_records",
    "intermediates",
    "latest_partition",
    "open_table",
    "read_table",
    "recover",
    "scan_hours",
    "shared_folder",
    "via_shared_table",
    "write_hour",
    "write_hours",
    "write_once",
]
