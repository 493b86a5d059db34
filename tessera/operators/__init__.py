"""DataFrame -> DataFrame operators: clean, keys, dims, fact, marts, quality."""

from tessera.operators.clean import (CleanSpec, Rule, apply_clean, audit, dedupe,
                                     drop_index_column, drop_rows, first_failed, null_columns,
                                     project, survivors_of, total_order)
from tessera.operators.dims import (area_dim, date_dim, keyed_dim, place_dim, representative,
                                    shift_of, time_dim, type_dim)
from tessera.operators.fact import (broadcast_checked, build_fact, fits_broadcast, integrity,
                                    known, lookup_key, measured)
from tessera.operators.keys import (ntile_of, with_ntile, with_ntiles, with_position,
                                    with_surrogate_key, with_unknown)
from tessera.operators.marts import (as_count, group_corr, group_rate, label, preview, rate,
                                     star_join, top_k, widget_series, with_share)
from tessera.operators.quality import (Check, coverage, distributions, duplicate_keys,
                                       numeric_domains, profile, quality_report, value_counts)

__all__ = [
    "CleanSpec", "Rule", "apply_clean", "audit", "dedupe", "drop_index_column", "drop_rows",
    "first_failed", "null_columns", "project", "survivors_of", "total_order",
    "area_dim", "date_dim", "keyed_dim", "place_dim", "representative", "shift_of", "time_dim",
    "type_dim",
    "broadcast_checked", "build_fact", "fits_broadcast", "integrity", "known", "lookup_key",
    "measured",
    "ntile_of", "with_ntile", "with_ntiles", "with_position", "with_surrogate_key",
    "with_unknown",
    "as_count", "group_corr", "group_rate", "label", "preview", "rate", "star_join", "top_k",
    "widget_series", "with_share",
    "Check", "coverage", "distributions", "duplicate_keys", "numeric_domains", "profile",
    "quality_report", "value_counts",
]
