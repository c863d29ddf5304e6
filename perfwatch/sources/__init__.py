"""Readers (S1-S5), sinks (S6-S8) and driver-table adapters."""
from perfwatch.sources.readers import (
    LayerMismatch,
    check_layer,
    read_devices,
    read_field_metrics,
    read_lab_reports,
    read_layer,
    read_page_loads,
)
from perfwatch.sources.sinks import export_csv, write_partitioned, write_table

__all__ = [
    "LayerMismatch", "check_layer", "export_csv", "read_devices", "read_field_metrics", "read_lab_reports", "read_layer",
    "read_page_loads", "write_partitioned", "write_table",
]
