"""Writers: partitioned Parquet, CSV, catalog tables and views."""

from .writers import (
    create_view,
    drop_partitions,
    partition_values,
    publish_table,
    publish_version,
    write_csv,
    write_partitioned,
)

__all__ = ["create_view", "drop_partitions", "partition_values", "publish_table", "publish_version", "write_csv", "write_partitioned"]
