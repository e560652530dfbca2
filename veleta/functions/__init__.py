from veleta.functions.casts import CASTS, parse_time, to_bool, to_double, to_int, to_long, to_text
from veleta.functions.json_paths import shred
from veleta.functions.naming import catalog_name, clean_identifier, flat_name

__all__ = [
    "CASTS", "catalog_name", "clean_identifier", "flat_name", "parse_time", "shred",
    "to_bool", "to_double", "to_int", "to_long", "to_text",
]
