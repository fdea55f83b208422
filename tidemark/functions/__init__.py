"""Column expressions. Everything here returns a ``Column`` made of Spark built-ins."""

from tidemark.functions.keys import date_key, key_bucket, surrogate_key, timestamp_text
from tidemark.functions.text import mask_email, parsed, trimmed

__all__ = [
    "date_key",
    "key_bucket",
    "mask_email",
    "parsed",
    "surrogate_key",
    "timestamp_text",
    "trimmed",
]
