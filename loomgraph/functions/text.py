"""String functions and key generators as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def pad(s: Column, char: Column, n: Column) -> Column:
    return F.rpad(s, F.greatest(F.length(s), n), char)


def split(s: Column, separator: str) -> Column:
    import re

    return F.split(s, "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in separator) if separator else re.escape(separator), -1)


def like(a: Column, b: Column) -> Column:
    """1 - 2 * edit distance / longer length: 1 for equal strings, -1 for strings without a place in common."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - 2.0 * F.levenshtein(a, b) / longest)


def encoded(x: Column) -> Column:
    return F.replace(F.url_encode(x.cast("string")), F.lit("+"), F.lit("%20"))


def lexical_key(base: Column, keys: list[Column]) -> Column:
    return F.concat(base, F.concat_ws("_", *[encoded(k) for k in keys]))


def hash_key(base: Column, keys: list[Column]) -> Column:
    return F.concat(base, F.sha2(F.concat_ws("_", *[encoded(k) for k in keys]), 256))


def random_key(base: Column) -> Column:
    return F.concat(base, F.uuid())
