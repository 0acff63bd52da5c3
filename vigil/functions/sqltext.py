"""Spark SQL text of the text functions, for ``SQLTransformer`` stages that persist
inside a ``PipelineModel`` (no Python UDF, so a saved model loads anywhere)."""

from __future__ import annotations

from vigil.functions.text import WHITESPACE_CLASS, ngram_pattern


def run_lengths_sql(items: str) -> str:
    """array<struct<value, n>> of an array: sorted once, cut where neighbours differ."""
    starts = "filter(sequence(0, greatest(size(x) - 1, 0)), i -> i < size(x) AND (i = 0 OR x[i] != x[i - 1]))"
    runs = "transform(st, (i, k) -> named_struct('value', x[i], 'n', coalesce(get(st, k + 1), size(x)) - i))"
    return f"transform(array(sort_array({items})), x -> transform(array({starts}), st -> {runs})[0])[0]"


def entropy_sql(c: str) -> str:
    """The sorted characters are joined and cut into runs by one pattern, natively; a pattern reads bytes that are no UTF-8 as one
    replacement character, so strings that hold such are cut element by element."""
    chars = f"split({c}, '')"
    runs = f"transform(regexp_extract_all(array_join(sort_array({chars}), ''), r'(?s)(.)\\1*+', 0), r -> length(r))"
    any_bytes = f"transform({run_lengths_sql(chars)}, r -> r.n)"
    return (f"CASE WHEN {c} IS NULL THEN CAST(NULL AS DOUBLE) WHEN length({c}) = 0 THEN 0.0D "
            f"ELSE log2(length({c})) - aggregate(CASE WHEN is_valid_utf8({c}) THEN {runs} ELSE {any_bytes} END, 0D, (acc, n) -> acc + n * log2(n)) "
            f"/ length({c}) + 0.0D END")


def normalized_sql(c: str) -> str:
    return f"regexp_replace(lower({c}), r'{WHITESPACE_CLASS}{WHITESPACE_CLASS}+', ' ')"


def ngrams_sql(text: str, n_min: int = 1, n_max: int = 3) -> str:
    """n-grams of a materialised column of normalized text, in order n then position (linear in the text); none of null."""
    parts = [f"coalesce(regexp_extract_all({text}, r'{ngram_pattern(n)}', 1), CAST(array() AS ARRAY<STRING>))" for n in range(n_min, n_max + 1)]
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"
