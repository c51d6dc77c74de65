"""Column-level helpers: every function returns a native Spark Column (no Python UDFs)."""

from lakelayer.functions.text import duration_flag, email_valid, hyphen_to_space, upper_name
from lakelayer.functions.nested import first_elem, join_words, last_match, or_else, strip_ref
from lakelayer.functions.hashing import HASH_EXCLUDE, hash_columns, record_hash
from lakelayer.functions.dates import day_sequence

__all__ = [
    "duration_flag", "email_valid", "hyphen_to_space", "upper_name",
    "first_elem", "join_words", "last_match", "or_else", "strip_ref",
    "HASH_EXCLUDE", "hash_columns", "record_hash", "day_sequence",
]
