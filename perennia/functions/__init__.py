"""Column-level helpers: every function returns a Column and stays inside the JVM."""

from perennia.functions.casts import encode_map, safe_cast, text_to_date, text_to_double, text_to_whole, to_int, year_at_most
from perennia.functions.columns import field, is_floating, is_integral, is_numeric, is_text
from perennia.functions.missing import MISSING_TEXT, missing, present_double
from perennia.functions.numeric import exact_means, hash_unit
from perennia.functions.ratings import rating

__all__ = [
    "MISSING_TEXT",
    "encode_map",
    "exact_means",
    "field",
    "hash_unit",
    "is_floating",
    "is_integral",
    "is_numeric",
    "is_text",
    "missing",
    "present_double",
    "rating",
    "safe_cast",
    "text_to_date",
    "text_to_double",
    "text_to_whole",
    "to_int",
    "year_at_most",
]
