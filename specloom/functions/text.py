"""Column expressions for metadata text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of a missing identifier, compared trimmed and in lower case.
UNDEFINED = ["", "n/a", "na", "nan", "none", "null", "no data"]

# A compound name's last word when it is likely not part of the name.
INCORRECT_LAST_WORDS = ["M", "M?", "?", "M+2H/2", "MS34+Na", "M]", "Cat+M]", "Unk", "--"]
INCORRECT_PHRASE = "F dial M"

# Shapes of identifiers.
INCHI_PATTERN = r'^\s*"?InChI='
INCHIKEY_PATTERN = r"^\s*[A-Z]{14}-[A-Z]{10}-[A-Z]\s*$"


def number(text: Column) -> Column:
    """Text to double; NULL where it is no number."""
    return text.try_cast("double")


def is_defined(value: Column) -> Column:
    return value.isNotNull() & ~F.lower(F.trim(value)).isin(UNDEFINED)


def defined(value: Column) -> Column:
    """The value, or an empty string for any spelling of "undefined"."""
    return F.when(is_defined(value), value).otherwise(F.lit(""))


def charge_number(text: Column) -> Column:
    """``1-``, ``-1``, ``2+`` or ``2`` to a signed integer; 0 when absent."""
    size = F.coalesce(F.regexp_extract(text, r"(\d+)", 1).try_cast("int"), F.lit(0))
    return F.when(F.coalesce(F.contains(text, F.lit("-")), F.lit(False)), -size).otherwise(size)


def bare_adduct(text: Column) -> Column:
    """``[M+H]`` to ``M+H``."""
    return F.translate(F.trim(text), "[]", "")


def tidy_compound_name(name: Column) -> Column:
    """Drop the known wrong phrase, then a last word known to be wrong."""
    without = F.replace(name, F.lit(INCORRECT_PHRASE), F.lit(""))
    words = F.split(without, " ")
    head = F.trim(F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "))
    return F.when(F.element_at(words, -1).isin(INCORRECT_LAST_WORDS), head).otherwise(without)


def inchikey_block(inchikey: Column) -> Column:
    """The structure part: the first 14 characters."""
    return F.substring(inchikey, 1, 14)
