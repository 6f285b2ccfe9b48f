from tabforge.sources.readers import (NA_TOKENS, apply_types, normalize_nulls,
                                     read_csv_strings, read_source)
from tabforge.sources.sinks import (OutputLayout, importance_sink, manifest_frame,
                                   prediction_table, scored_original, scored_transformed,
                                   write_table)

__all__ = [
    "NA_TOKENS", "apply_types", "normalize_nulls", "read_csv_strings", "read_source",
    "OutputLayout", "importance_sink", "manifest_frame", "prediction_table",
    "scored_original", "scored_transformed", "write_table",
]
