"""Rule checks for a (text, binary target) training table and the phase-aware validation gate.

Every rule is a boolean column; counting them is one aggregate (partial on the
map side, merged in one small final task), so a gate over any number of rows
is a single pass with a one-row result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.parse import numeric_or_null
from vigil.functions.text import strip_ws

# The text pattern, the allowed target values, default bounds.
TEXT_PATTERN = r"^[a-z]+$"
ALLOWED_TARGET_VALUES = (0.0, 1.0)
DEFAULT_MAX_TEXT_LENGTH = 128
DEFAULT_MIN_POSITIVE_SHARE = 0.30
DEFAULT_MAX_POSITIVE_SHARE = 0.70

# (rule, which column, message); order is the order errors are reported in.
RULES = (
    ("text_missing", "text", "Column {text} contains missing values"),
    ("text_empty", "text", "Column {text} contains empty values after stripping whitespace"),
    ("text_pattern", "text", "Column {text} must contain only lowercase letters a-z"),
    ("text_length", "text", "Column {text} length must be between 1 and {max_length} characters"),
    ("target_missing", "target", "Column {target} contains missing values"),
    ("target_non_numeric", "target", "Column {target} contains non-numeric values"),
    ("target_infinite", "target", "Column {target} contains infinite values"),
    ("target_not_allowed", "target", "Column {target} values must be exactly one of {{0.0, 1.0}}"),
)


def rule_flag_columns(text: str, target: str, max_length: int = DEFAULT_MAX_TEXT_LENGTH) -> dict[str, Column]:
    t = F.col(text)
    clean = strip_ws(t.cast("string"))
    num = numeric_or_null(F.col(target))
    num = F.when(~F.isnan(num), num)
    text_missing = t.isNull()
    text_empty = ~text_missing & (clean == "")
    finite = num.isNotNull() & (F.abs(num) != F.lit(float("inf")))
    return {
        "text_missing": text_missing,
        "text_empty": text_empty,
        "text_pattern": ~text_missing & ~text_empty & ~clean.rlike(TEXT_PATTERN),
        "text_length": ~text_missing & ((F.length(clean) < 1) | (F.length(clean) > max_length)),
        "target_missing": F.col(target).isNull(),
        "target_non_numeric": F.col(target).isNotNull() & num.isNull(),
        "target_infinite": num.isNotNull() & ~finite,
        "target_not_allowed": finite & ~num.isin(*ALLOWED_TARGET_VALUES),
    }


def with_rule_flags(df: DataFrame, text: str, target: str, max_length: int = DEFAULT_MAX_TEXT_LENGTH) -> DataFrame:
    """Add one boolean column per rule (``rule_<name>``) — the per-row rejects view."""
    flags = rule_flag_columns(text, target, max_length)
    return df.withColumns({f"rule_{k}": v for k, v in flags.items()})


def rule_violation_counts(df: DataFrame, text: str, target: str,
                          max_length: int = DEFAULT_MAX_TEXT_LENGTH) -> DataFrame:
    """One row per rule: (rule, column_name, n_violations); a single aggregate, then unpivot."""
    flags = rule_flag_columns(text, target, max_length)
    counts = df.agg(*[F.count_if(v).alias(k) for k, v in flags.items()])
    names = {"text": text, "target": target}
    stacked = ", ".join(f"'{r}', '{names[which]}', `{r}`" for r, which, _ in RULES)
    return counts.selectExpr(f"stack({len(RULES)}, {stacked}) AS (rule, column_name, n_violations)")


def clean_training_table(df: DataFrame, text: str, target: str) -> DataFrame:
    """Required columns only, text stripped, target as double (lazy; valid only after the gate passes)."""
    return df.select(strip_ws(F.col(text).cast("string")).alias(text),
                     numeric_or_null(F.col(target)).alias(target))


def _py_list(names) -> str:
    return "[" + ", ".join(repr(str(n)) for n in names) + "]"


def _gate_row(df: DataFrame, text: str, target: str, *,
                      max_length: int = DEFAULT_MAX_TEXT_LENGTH,
                      min_positive_share: float = DEFAULT_MIN_POSITIVE_SHARE,
                      max_positive_share: float = DEFAULT_MAX_POSITIVE_SHARE,
                      required: list[str] | None = None) -> DataFrame:
    required = list(required or [text, target])
    columns = list(df.columns)
    seen, dups = set(), []
    for c in columns:
        if c in seen:
            dups.append(c)
        seen.add(c)
    # Structural facts known from the schema alone.
    static_a = []
    if dups:
        static_a.append(f"DataFrame contains duplicate columns: {', '.join(dups)}")
    if columns != required:
        static_a.append(f"DataFrame columns must exactly match {_py_list(required)} in order; found {_py_list(columns)}")
    unique_cols = list(dict.fromkeys(columns))
    have_rules = not dups and text in columns and target in columns
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(_all_null([F.col(f"`{c}`") for c in unique_cols])).alias("n_empty_rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(unique_cols)]
    if have_rules:
        flags = rule_flag_columns(text, target, max_length)
        aggs += [F.count_if(v).alias(k) for k, v in flags.items()]
        num = numeric_or_null(F.col(target))
        aggs.append(F.avg((num > 0).cast("double")).alias("positive_share"))
    s = df.agg(*aggs)

    empty_cols = F.filter(F.array(*[F.when(F.col(f"nn_{i}") == 0, F.lit(c)) for i, c in enumerate(unique_cols)]),
                          lambda x: x.isNotNull())
    phase_a = [
        F.when(F.col("n_rows") == 0, F.lit("DataFrame must contain at least one row")),
        F.when(F.col("n_empty_rows") > 0,
               F.format_string("DataFrame contains fully empty rows: %d rows", F.col("n_empty_rows"))),
        F.when(F.size(empty_cols) > 0,
               F.concat(F.lit("DataFrame contains fully empty columns: "), F.array_join(empty_cols, ", "))),
    ] + [F.lit(m) for m in static_a]
    phase_b, phase_c = [], []
    if have_rules:
        names = {"text": text, "target": target, "max_length": max_length}
        phase_b = [F.when(F.col(r) > 0, F.lit(msg.format(**names))) for r, _, msg in RULES]
        phase_c = [F.when(~F.col("positive_share").between(min_positive_share, max_positive_share),
                          F.format_string(
                              f"Column {target} has invalid target distribution: positive share is %.3f; "
                              f"expected between {min_positive_share:.2f} and {max_positive_share:.2f}",
                              F.col("positive_share")))]

    def present(items):
        return F.filter(F.array(*items), lambda x: x.isNotNull()) if items else F.array().cast("array<string>")

    a, b, c = present(phase_a), present(phase_b), present(phase_c)
    errors = (F.when(F.size(a) > 0, a)
               .when(F.size(b) > 0, b)
               .otherwise(c))
    return s.select("n_rows", errors.alias("errors"))


def validation_errors(df: DataFrame, text: str, target: str, **kw) -> DataFrame:
    """Ordered error list of the gate as rows (error_index, error); no rows = valid.

    Phase A (structure) stops the check; phase B (column rules) runs only when A
    is clean; phase C (target share) only when A and B are clean.  All counts
    come from one aggregate; the phase masks are applied to that one row.
    """
    return _gate_row(df, text, target, **kw).select(F.posexplode("errors").alias("error_index", "error"))


def _all_null(cols: list[Column]) -> Column:
    cond = cols[0].isNull()
    for c in cols[1:]:
        cond = cond & c.isNull()
    return cond


def validation_report(df: DataFrame, text: str, target: str, **kw) -> DataFrame:
    """One-row report: is_valid, errors (ordered), n_rows, columns — from the same single aggregate."""
    return (_gate_row(df, text, target, **kw)
            .select((F.size("errors") == 0).alias("is_valid"), "errors", "n_rows",
                    F.array(*[F.lit(c) for c in df.columns]).alias("columns")))


def request_guard(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Scoring-input guard: (accepted, rejected). A null or blank string is rejected with a reason."""
    blank = F.col(text).isNull() | (strip_ws(F.col(text).cast("string")) == "")
    flagged = df.withColumn("_blank", F.coalesce(blank, F.lit(True)))
    accepted = flagged.filter(~F.col("_blank")).drop("_blank")
    rejected = (flagged.filter(F.col("_blank")).drop("_blank")
                .withColumn("reason", F.lit("Each password must be a non-empty string")))
    return accepted, rejected
