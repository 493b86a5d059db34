"""Column expressions (JVM-side, codegen-friendly); no Python UDFs."""

from tessera.functions.parse import (clean_text, flag, in_box, null_unless, pad_code, to_double,
                                     to_int, to_long, to_ts, upper_flag, valid)
from tessera.functions.dates import date_key, date_parts

__all__ = ["clean_text", "flag", "in_box", "null_unless", "pad_code", "to_double", "to_int",
           "to_long", "to_ts", "upper_flag", "valid", "date_key", "date_parts"]
