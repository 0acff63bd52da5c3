"""Text expressions: whitespace strip, character entropy, character n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.isspace`` treats as whitespace,
# written as one regex class both Java regex and RE2 accept.
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading and trailing Unicode whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def squeeze_ws(c) -> Column:
    """Replace every run of two or more whitespace characters by one space."""
    return F.regexp_replace(_col(c), f"{WHITESPACE_CLASS}{WHITESPACE_CLASS}+", " ")


def text_length(c) -> Column:
    return F.length(_col(c))


def let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once a row however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def run_lengths(items) -> Column:
    """The distinct elements of an array with their numbers, as array<struct<value, n>> in ascending order: the array is sorted
    once and cut where neighbours differ, so the cost is that of the sort, however many elements are distinct. ``sort_array``
    compares the values themselves; ``array_sort`` would evaluate a comparison expression for each pair."""
    def counted(x):
        n = F.size(x)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & ((i == 0) | (F.get(x, i) != F.get(x, i - 1))))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(x, i).alias("value"), (F.coalesce(F.get(at, k + 1), n) - i).alias("n"))))

    return let(F.sort_array(_col(items)), counted)


def char_entropy(c) -> Column:
    """Shannon entropy in bits of the character distribution of a string; '' → 0.0, null → null.

    H = log2(L) - (1/L) * sum_c n_c * log2(n_c), with n_c the run lengths of the
    sorted characters: no explode, no shuffle, no pass per distinct character.
    """
    s = _col(c)
    weighted = F.aggregate(run_lengths(F.split(s, "")), F.lit(0.0), lambda acc, r: acc + r["n"] * F.log2(r["n"].cast("double")))
    length = F.length(s).cast("double")
    return (F.when(s.isNull(), F.lit(None).cast("double"))
            .when(F.length(s) == 0, F.lit(0.0))
            .otherwise(F.log2(length) - weighted / length + F.lit(0.0)))


def normalized_text(c, lowercase: bool = True, normalize_whitespace: bool = True) -> Column:
    """The text after lowercasing and whitespace squeezing."""
    s = _col(c)
    if lowercase:
        s = F.lower(s)
    if normalize_whitespace:
        s = squeeze_ws(s)
    return s


def normalized_chars(c, lowercase: bool = True, normalize_whitespace: bool = True) -> Column:
    """The text as an array of characters, after lowercasing and whitespace squeezing."""
    return F.split(normalized_text(c, lowercase, normalize_whitespace), "")


def ngram_pattern(n: int) -> str:
    """A pattern whose group 1 is the n characters from each place of a text that has so many left; it takes one character a match."""
    return rf"(?s)(?=({'.' * n}))."


def ngrams_from_text(c, n_min: int = 1, n_max: int = 3) -> Column:
    """``ngrams_from_chars`` of a column of normalized text, cut natively by a pattern for each n: no array of characters is kept,
    and no expression is evaluated for each place. ``c`` is read once for each n, so pass a materialised column."""
    none = F.array().cast("array<string>")
    parts = [F.coalesce(F.regexp_extract_all(_col(c), F.lit(ngram_pattern(n)), 1), none) for n in range(n_min, n_max + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def ngrams_from_chars(chars, n_min: int = 1, n_max: int = 3) -> Column:
    """All n-grams (n_min..n_max, in order n then position) of a character array.

    Built from O(1) array element reads, so the cost is linear in the text;
    pass a materialised column (not an expression) so it is computed once.
    """
    ch = _col(chars)
    size = F.when(ch.isNull(), F.lit(0)).when((F.size(ch) == 1) & (F.element_at(ch, 1) == ""), F.lit(0)) \
        .otherwise(F.size(ch))

    def take(n):
        return lambda i: F.concat(*[F.element_at(ch, i + k) for k in range(n)])

    parts = []
    for n in range(n_min, n_max + 1):
        grams = F.transform(F.sequence(F.lit(1), size - F.lit(n - 1)), take(n))
        parts.append(F.when(size >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_ngrams(c, n_min: int = 1, n_max: int = 3, lowercase: bool = True,
                normalize_whitespace: bool = True) -> Column:
    """All character n-grams of length n_min..n_max, in order (n, position).

    Whitespace runs of 2+ become one space and the text is lowercased first,
    as a character analyzer with default options does.  For long texts prefer
    ``with_ngrams`` in ``operators.textfeatures``, which materialises the
    character array once.
    """
    return ngrams_from_chars(normalized_chars(c, lowercase, normalize_whitespace), n_min, n_max)
