from starloom.sources.inventory import file_inventory
from starloom.sources.readers import conform, read_csv, read_many, read_table, read_with_rejects, register
from starloom.sources.versions import drop_versions, publish_version, read_version
from starloom.sources.writers import (
    exists,
    publish,
    read_partitioned,
    stage,
    write_bucketed,
    write_partitioned,
    write_table,
)

__all__ = [
    "conform",
    "drop_versions",
    "exists",
    "file_inventory",
    "publish",
    "publish_version",
    "read_csv",
    "read_many",
    "read_partitioned",
    "read_table",
    "read_version",
    "read_with_rejects",
    "register",
    "stage",
    "write_bucketed",
    "write_partitioned",
    "write_table",
]
