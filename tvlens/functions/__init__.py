"""Column helpers (see :mod:`tvlens.functions.columns`)."""

from tvlens.functions.columns import (  # noqa: F401
    DAY_NAMES,
    bands,
    cycle,
    day_gap,
    day_name,
    day_span,
    dow0,
    hash_bucket,
    hash_int,
    hash_unit,
    hour_slot,
    json_object,
    key_hash,
    mode_of,
    padded,
    per_hour,
    per_minute,
    programme_key,
    ratio,
    share_if,
    since,
    stable_id,
    strict_greatest,
    strict_least,
    to_variant,
    value_map,
    week_start,
)
