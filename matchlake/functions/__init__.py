"""Column expressions used by the operators."""

from matchlake.functions.text import (
    array_slots,
    asset_url,
    batch_label,
    champion_source_url,
    icon_slots,
    icon_url,
    joined,
    json_bool,
    ordered_concat,
    patch_of,
    performance_tier,
    round2,
    set_number_of,
    strip_item_prefix,
    strip_set_prefix,
    truncate_error,
)

__all__ = [
    "array_slots",
    "asset_url",
    "batch_label",
    "champion_source_url",
    "icon_slots",
    "icon_url",
    "joined",
    "json_bool",
    "ordered_concat",
    "patch_of",
    "performance_tier",
    "round2",
    "set_number_of",
    "strip_item_prefix",
    "strip_set_prefix",
    "truncate_error",
]
