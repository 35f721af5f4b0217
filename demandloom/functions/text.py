"""Column expressions for cleaning text, and header-name rules.

Everything that touches rows is a built-in Spark expression. Header names are
metadata, so those rules are plain Python on a short list of names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandloom import config

_CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"
_FORMULA = "^[=+\\-@\\t\\r]"


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def parse_number(value: Column, data_type: str = config.QUANTITY_TYPE) -> Column:
    """``1.234,500-`` style text to a number; unreadable text gives NULL."""
    text = F.trim(value)
    moved = F.regexp_replace(text, "^(.*)-$", "-$1")
    plain = F.translate(moved, ",.", ".")
    return plain.try_cast(data_type)


def format_number(value: Column, decimals: int = 3) -> Column:
    """The inverse of :func:`parse_number`: thousands dots, comma, trailing minus."""
    digits = F.translate(F.format_number(F.abs(value), decimals), ",.", ".,")
    return F.when(value < 0, F.concat(digits, F.lit("-"))).otherwise(digits)


def parse_date(value: Column, pattern: str = "dd.MM.yyyy") -> Column:
    """Text to DATE; a date that does not exist gives NULL."""
    return F.try_to_date(F.trim(value), pattern)


def strip_leading_zeros(value: Column) -> Column:
    return F.regexp_replace(value, "^0+", "")


def default_when_blank(value: Column, key: Column, defaults: Mapping[str, str]) -> Column:
    """Keep a filled value; otherwise look the default up by ``key`` (else NULL)."""
    lookup = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    return F.coalesce(blank_to_null(value), F.try_element_at(lookup, key))


def chain_head(
    head: Column, material: Column, company: Column,
    suffixes: Mapping[str, str] = config.CHAIN_SUFFIXES,
) -> Column:
    """The chain head of a part: own number when unset, without the variant letter.

    Blank and "sim" count as unset. The trailing letter, set off by white
    space, is dropped only for the companies listed in ``suffixes``; it is
    dropped from a fallback part number as well.
    """
    mark = F.lower(F.trim(head))
    chosen = F.when((mark == "") | (mark == "sim"), material).otherwise(F.coalesce(head, material))
    cleaned = chosen
    for code, letters in suffixes.items():
        shorter = F.rtrim(F.regexp_replace(chosen, f"\\s+[{letters}]$", ""))
        applies = (company == code) & chosen.rlike(f"\\s[{letters}]$")
        cleaned = F.when(applies, shorter).otherwise(cleaned)
    return cleaned


def neutralise_formula(value: Column) -> Column:
    """Put an apostrophe before text that a spreadsheet would run as a formula."""
    return F.when(value.rlike(_FORMULA), F.concat(F.lit("'"), value)).otherwise(value)


def drop_control_characters(value: Column) -> Column:
    return F.regexp_replace(value, _CONTROL, "")


def cell_text(value: Column) -> Column:
    return neutralise_formula(drop_control_characters(value))


def sheet_name(value: Column) -> Column:
    """A legal sheet name: forbidden characters to ``-``, no outer ``'``, 31 long."""
    legal = F.regexp_replace(value, "[\\[\\]:*?/\\\\]", "-")
    bare = F.regexp_replace(legal, "^'+|'+$", "")
    short = F.substring(bare, 1, config.SHEET_NAME_LENGTH)
    return F.when(short == "", config.DEFAULT_SHEET_NAME).otherwise(short)


def unsafe_file_name(value: Column) -> Column:
    return value.contains("/") | value.contains("..")


def route_prefix(file_name: Column) -> Column:
    """Text before the first ``_``; without one, the name less its extension."""
    stem = F.regexp_replace(file_name, "(?<=.)\\.[^.]*$", "")
    return F.when(file_name.contains("_"), F.substring_index(file_name, "_", 1)).otherwise(stem)


def clean_header(name: str | None) -> str:
    """Header text to a column name: no accents, lower case, ``_`` for the rest."""
    plain = unicodedata.normalize("NFKD", name or "").encode("ascii", "ignore").decode("ascii")
    return re.sub("[^a-z0-9]+", "_", plain.lower()).strip("_") or "col_unknown"


def clean_headers(names: Sequence[str | None], renames: Mapping[str, str] | None = None) -> list[str]:
    """Clean every header, rename by map, and number repeats ``_1``, ``_2``…"""
    renames = renames or {}
    taken: set[str] = set()
    result = []
    for name in names:
        base = clean_header(name)
        base = renames.get(base, base)
        candidate, number = base, 0
        while candidate in taken:
            number += 1
            candidate = f"{base}_{number}"
        taken.add(candidate)
        result.append(candidate)
    return result


def clean_history_headers(names: Sequence[str]) -> list[str]:
    """Clean business headers; technical names keep their leading underscore."""
    technical = {*config.SOURCE_COLUMNS, *config.AUDIT_COLUMNS}
    cleaned = iter(clean_headers([n for n in names if n not in technical]))
    return [n if n in technical else next(cleaned) for n in names]
