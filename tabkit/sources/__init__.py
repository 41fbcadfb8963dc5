"""Readers and writers."""
from .readers import (  # noqa: F401
    first_csv, read_csv, read_dictionary, read_rows, selected_model,
)
from .writers import (  # noqa: F401
    load_params, load_pipeline, save_params, save_pipeline, write_csv, write_metadata,
    write_parquet, write_report_json, write_report_text, write_splits,
)
