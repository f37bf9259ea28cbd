from vitaria.sources.bronze import (
    BronzeLayout, dataset_files, dataset_glob, list_datasets, partition_grid, region_states,
    scan_bronze, scan_datasets,
)
from vitaria.sources.dictionary import CodeDictionary
from vitaria.sources.tables import (
    dataset_schemas, delta_available, read_delta, read_mixed, read_records, read_silver, silver_path,
)

__all__ = [
    "BronzeLayout", "CodeDictionary", "dataset_files", "dataset_glob", "dataset_schemas", "delta_available",
    "list_datasets", "partition_grid", "read_delta", "read_mixed", "read_records",
    "read_silver", "region_states", "scan_bronze", "scan_datasets", "silver_path",
]
