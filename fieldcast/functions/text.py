"""Text helpers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

_SPACE = " \t\n\r\f\v"


def strip_space(value: Column) -> Column:
    """Trim every kind of ASCII white space (plain trim takes blanks only)."""
    return F.btrim(value, F.lit(_SPACE))


def dept_code_normalise(code: Column) -> Column:
    """' 1.0' -> '01', '2A' -> '2A', '974' -> '974'."""
    text = F.regexp_replace(strip_space(code.cast("string")), r"\.0$", "")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def number_text(value: Column, digits: int = 1, suffix: str = "", missing: str = "not available") -> Column:
    """Number with a blank as thousands separator and fixed decimals."""
    text = F.concat(F.format_number(value.cast("double"), digits), F.lit(suffix))
    return F.coalesce(F.replace(text, F.lit(","), F.lit(" ")), F.lit(missing))


def yes_no(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), F.lit("yes")).otherwise(F.lit("no"))


def lookup(code: Column, labels: dict) -> Column:
    """Label of a code from a small fixed table, NULL where it has none."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.try_element_at(pairs, code)
