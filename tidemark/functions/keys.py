"""Blank tests, key comparison rules and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Compares like a case-insensitive database that ignores trailing blanks. Opt in: the default is
# plain binary comparison, which is faster and hashes in code generation.
CASELESS = "UTF8_LCASE_RTRIM"

GUID = r"^\{?([0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})\}?$"


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def is_filled(value: str | Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.rtrim(col(value).cast("string")), F.lit("")) != ""


def comparable(value: str | Column, collation: str | None = None) -> Column:
    """The value as it takes part in grouping and joining."""
    return F.collate(col(value), collation) if collation else col(value)


def guid_text(value: str | Column) -> Column:
    """Upper-case identifier without braces, null if the text is not one."""
    found = F.regexp_extract(F.trim(col(value)), GUID, 1)
    return F.nullif(F.upper(found), F.lit(""))


def tenant_key(value: str | Column) -> Column:
    """Organisation identifiers differ in case and braces between files; compare this instead."""
    return F.upper(F.btrim(F.rtrim(col(value).cast("string")), F.lit("{}")))


def whole_number(value: str | Column) -> Column:
    """Integer for plain digits with an optional sign, otherwise null (so ``5.0`` is refused)."""
    text = F.trim(col(value))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
