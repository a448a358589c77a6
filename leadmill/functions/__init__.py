from leadmill.functions.casts import safe_cast, strip_path_prefix, try_cast
from leadmill.functions.keys import fact_key, packed_key, surrogate_key, unpacked_key
from leadmill.functions.times import (
    calendar_parts,
    day_diff,
    epoch_ns_to_ts,
    first_date_field,
    first_whole_day,
    hour_boundaries,
    is_time_type,
    parse_batch_id,
    stamp,
)
from leadmill.functions.values import flag, outcome_label, zero_safe_ratio

__all__ = [
    "calendar_parts",
    "day_diff",
    "epoch_ns_to_ts",
    "fact_key",
    "first_date_field",
    "first_whole_day",
    "flag",
    "hour_boundaries",
    "is_time_type",
    "outcome_label",
    "packed_key",
    "parse_batch_id",
    "safe_cast",
    "stamp",
    "strip_path_prefix",
    "surrogate_key",
    "unpacked_key",
    "try_cast",
    "zero_safe_ratio",
]
