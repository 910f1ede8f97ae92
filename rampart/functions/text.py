"""Name and address normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash_spaces(c: Column) -> Column:
    """Collapse every run of whitespace (tabs included) to one space, then trim;
    an empty result is NULL."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def split_name(c: Column) -> tuple[Column, Column]:
    """Full name -> (first_name, last_name).

    The last word is the first name; every word before it is the last name.
    A single word gives last_name NULL; NULL or blank gives both NULL.
    """
    norm = squash_spaces(c)
    first = F.regexp_extract(norm, r"([^ ]+)$", 1)
    last = F.when(norm.contains(" "), F.regexp_extract(norm, r"^(.*) [^ ]+$", 1))
    return F.when(norm.isNotNull(), first), last


def address_parts(c: Column) -> Column:
    """Comma-separated parts, each whitespace-normalised, empty parts dropped."""
    parts = F.transform(F.split(c, ","), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    return F.filter(parts, lambda p: p != F.lit(""))


def split_address(c: Column) -> tuple[Column, Column]:
    """Address -> (cleaned address, province).

    Parts are re-joined with ``", "``; the province is the last part when
    there are at least two parts. No parts at all gives both NULL.
    """
    parts = address_parts(c)
    n = F.size(parts)
    address = F.when(c.isNotNull() & (n > 0), F.array_join(parts, ", "))
    province = F.when(n > 1, F.element_at(parts, -1))
    return address, province
