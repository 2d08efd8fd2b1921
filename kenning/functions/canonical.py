"""JSON texts in one form, whatever the order of their keys and their white space, as column functions.

Parsing goes through VARIANT, which keeps an object's fields in the order of their names at every depth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A comma or colon outside strings, with what stands before it since the last one.
_BREAK = r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])*+[,:])'
HASH_CHARS = 16


def compact(text: Column) -> Column:
    """Keys sorted, no white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(text))


def spaced(text: Column) -> Column:
    """Keys sorted, a space after each comma and colon outside strings."""
    return F.regexp_replace(compact(text), _BREAK, "$1 ")


def content_hash(text: Column) -> Column:
    """First 16 hexadecimal digits of the SHA-256 of the sorted form; what isn't JSON is hashed as it stands."""
    return F.substring(F.sha2(F.coalesce(spaced(text), text).cast("binary"), 256), 1, HASH_CHARS)


def search_text(text: Column) -> Column:
    """Keys and values in their sorted form, lower-cased, to look words up in."""
    return F.lower(F.coalesce(spaced(text), text))
