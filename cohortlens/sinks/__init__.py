"""Sinks: tables, CSV, JSON records, id-keyed JSON objects, metrics, models.

Writers are plain ``DataFrameWriter`` calls, so every task writes its own
part files; nothing is gathered on the driver or in one task.
"""

from cohortlens.sinks.writers import (  # noqa: F401
    load_pipeline,
    save_pipeline,
    scratch_path,
    write_csv,
    write_feature_columns,
    write_json_map,
    write_json_objects,
    write_json_records,
    write_metrics,
    write_statistics,
    write_table,
)
