"""Pure Column -> Column functions."""

from .numeric import (
    discount_pct,
    not_a_number,
    not_money,
    or_zero,
    py_round,
    safe_divide,
    to_double,
    to_money,
)
from .presence import is_present, presence
from .text import blank_to_null, get_attr, id_or_null
from .time import as_of_literal, hours_between, iso_text, utc_now, wall_clock
from .variant import is_unparsed, texts_of, to_variant, value_at

__all__ = [
    "as_of_literal", "blank_to_null", "discount_pct", "get_attr", "hours_between",
    "id_or_null", "is_present", "is_unparsed", "iso_text", "not_a_number", "not_money", "or_zero", "presence",
    "py_round",
    "safe_divide", "texts_of", "to_double", "to_money", "to_variant", "utc_now", "value_at",
    "wall_clock",
]
