"""Landing-file scans and the table catalog."""

from tessera.sources.files import normalize_columns, normalize_name, read_raw_csv, stamp, write_csv
from tessera.sources.catalog import (apply_comments, data_dictionary, ensure_layers, list_tables,
                                     save, save_all)

__all__ = ["normalize_columns", "normalize_name", "read_raw_csv", "stamp", "write_csv",
           "apply_comments", "data_dictionary", "ensure_layers", "list_tables", "save", "save_all"]
