"""DataFrame -> DataFrame operators (projections, joins, aggregates, gates)."""

from .aggregates import distinct_values, preview, status_report, top_n
from .joins import (StarKeys, first_match, first_per_key, lookup, lookup_fill,
                    order_items_view)
from .projection import apply_mapping, conform, drop_pii, where_equals
from .quality import (EmptyOutputError, NoInputError, QuarantineError, counted, require_path,
                      require_rows)

__all__ = [
    "EmptyOutputError", "NoInputError", "QuarantineError", "StarKeys", "apply_mapping", "conform",
    "counted",
    "distinct_values", "drop_pii", "first_match", "first_per_key", "lookup", "lookup_fill",
    "order_items_view", "preview", "require_path", "require_rows", "status_report", "top_n",
    "where_equals",
]
