"""DuckDB SQL fragments that mirror the Spark column functions (for the oracles)."""

from __future__ import annotations

from vigil.functions.parse import _NUMERIC_RE
from vigil.functions.text import WHITESPACE_CLASS as W


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{W}+|{W}+$', '', 'g')"


def squeeze(e: str) -> str:
    return f"regexp_replace({e}, '{W}{W}+', ' ', 'g')"


def numeric(e: str) -> str:
    s = strip(f"CAST({e} AS VARCHAR)")
    return f"(CASE WHEN regexp_matches({s}, '{_NUMERIC_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"


TRAINING_VIEW = """
    SELECT d.text AS text, CAST(l.quality AS VARCHAR) AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
