"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space (Unicode, not only ASCII).
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def lstrip(c: Column) -> Column:
    """Looks at the beginning only, where a strip of the end takes the whole text apart."""
    return F.ltrim(c, F.lit(SPACE_CHARS))


def is_space(c: Column) -> Column:
    return lstrip(c) == ""


def squash_spaces(c: Column) -> Column:
    """No white space at the ends, single spaces inside; one regex pass."""
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def title_case(c: Column) -> Column:
    """First letter of each word up, the rest down; only white space separates words."""
    return F.initcap(squash_spaces(c))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def email_domain(c: Column) -> Column:
    return F.substring_index(c, "@", -1)
