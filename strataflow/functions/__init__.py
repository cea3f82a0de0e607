"""Column-in, column-out cleaning functions. A value that cannot be read becomes NULL."""

from .dates import (
    age_band,
    age_exact,
    age_years,
    day_lenient,
    day_normalised,
    day_padded,
    day_text,
    day_unpadded,
    timestamp_text,
)
from .text import (
    LIKELY_EMAIL,
    blank_to_null,
    email_key,
    first_name_of,
    last_name_of,
    money,
    without_token,
    whole_number,
)

__all__ = [
    "LIKELY_EMAIL",
    "age_band",
    "age_exact",
    "age_years",
    "blank_to_null",
    "day_lenient",
    "day_normalised",
    "day_padded",
    "day_text",
    "day_unpadded",
    "email_key",
    "first_name_of",
    "last_name_of",
    "money",
    "timestamp_text",
    "whole_number",
    "without_token",
]
