"""Column builders. None of them runs a job."""

from .hashing import canonical_text, key_hash, row_digest, row_fingerprint
from .numeric import (
    bias_direction,
    duration_in_years,
    is_finite,
    ordered_bits,
    percent_below,
    percent_of,
    position_in,
    relation_text,
    residual,
    right_closed_band,
    underestimated_share,
)
from .text import (
    MISSING_TOKENS,
    UNKNOWN_LABEL,
    is_missing,
    join_labels,
    label_for,
    normalized_code,
    parse_number,
    trimmed,
)

__all__ = [
    "MISSING_TOKENS",
    "UNKNOWN_LABEL",
    "bias_direction",
    "canonical_text",
    "duration_in_years",
    "is_finite",
    "is_missing",
    "join_labels",
    "key_hash",
    "label_for",
    "normalized_code",
    "ordered_bits",
    "parse_number",
    "percent_below",
    "percent_of",
    "position_in",
    "relation_text",
    "residual",
    "right_closed_band",
    "row_digest",
    "row_fingerprint",
    "trimmed",
    "underestimated_share",
]
