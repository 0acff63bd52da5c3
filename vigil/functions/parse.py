"""Parsing expressions for raw (all-string) inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.text import strip_ws

# Strings a CSV reader with default settings treats as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Strings read as a true flag.
TRUTHY = ("1", "true", "yes", "y", "on")

# A decimal or scientific number, or an infinity / nan spelling; rejects the
# '1d' / '1f' suffixes a plain cast would accept.
_NUMERIC_RE = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing_token(c) -> Column:
    """True when a raw string is null or one of the missing-value spellings (unstripped, as a reader sees it)."""
    x = _col(c)
    return x.isNull() | x.isin(list(MISSING_TOKENS))


def looks_numeric(c) -> Column:
    return strip_ws(_col(c)).rlike(_NUMERIC_RE)


def numeric_or_null(c) -> Column:
    """Coerce a raw string to double; anything that is not a plain number becomes null."""
    x = strip_ws(_col(c).cast("string"))
    return F.when(x.rlike(_NUMERIC_RE), x.try_cast("double"))


def truthy(c) -> Column:
    return F.lower(F.trim(_col(c))).isin(list(TRUTHY))


def split_list(c, sep: str = ",") -> Column:
    """Split a separated list, strip items, drop blanks."""
    items = F.transform(F.split(_col(c), sep), lambda x: strip_ws(x))
    return F.filter(items, lambda x: x != "")


def empty_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def none_label(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit("<none>"))
