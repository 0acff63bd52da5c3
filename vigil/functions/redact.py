"""Redaction expressions for logs, urls, JSON maps and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.text import WHITESPACE_CLASS, let

# Replacement marker and the key fragments that mark a key as sensitive.
REDACTED = "[REDACTED]"
SENSITIVE_KEY_PARTS = ("secret", "credential", "password", "token", "key")

_NOT_WS = WHITESPACE_CLASS[1:-1]
# Fixed value: '://user:pass@' inside a url.
URL_CREDENTIALS_PATTERN = rf"(://)([^/{_NOT_WS}:@]+):([^@/{_NOT_WS}]+)@"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def redact_url_credentials(c) -> Column:
    return F.regexp_replace(_col(c), URL_CREDENTIALS_PATTERN, f"$1{REDACTED}:{REDACTED}@")


def redact_secret_values(c, secrets) -> Column:
    """Replace every known secret value, longest first, by the marker."""
    out = _col(c)
    for value in sorted({s for s in secrets if s}, key=lambda s: (-len(s), s)):
        out = F.replace(out, F.lit(value), F.lit(REDACTED))
    return out


def is_sensitive_key(k) -> Column:
    lk = F.lower(_col(k))
    cond = F.lit(False)
    for part in SENSITIVE_KEY_PARTS:
        cond = cond | lk.contains(part)
    return cond


#: Stand-ins for an escaped backslash and an escaped quote; valid JSON has no such control characters in its text.
_BACKSLASH, _QUOTE = "\x01", "\x02"


def _raw(c: Column) -> Column:
    """A JSON string's inside with its escapes back."""
    return F.replace(F.replace(c, F.lit(_BACKSLASH), F.lit("\\\\")), F.lit(_QUOTE), F.lit('\\"'))


def _decoded(c: Column) -> Column:
    """The text of a JSON string's inside."""
    plain = ~(c.contains("\\") | c.contains(_BACKSLASH) | c.contains(_QUOTE))
    return F.when(plain, c).otherwise(F.get(F.from_json(F.concat(F.lit('["'), _raw(c), F.lit('"]')), "array<string>"), F.lit(0)))


def _encoded(c: Column) -> Column:
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _end_of_container(structure: Column, depth: Column) -> Column:
    """Where, in a piece between strings, ``depth`` open brackets are all closed: the place after the last bracket (from 1), else 0; and the depth at the end."""
    start = F.struct(depth.cast("int").alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("i"))

    def step(z, ch):
        d = z["depth"] + F.when(ch.isin("{", "["), 1).when(ch.isin("}", "]"), -1).otherwise(0)
        i = z["i"] + 1
        return F.struct(F.when(z["at"] > 0, z["depth"]).otherwise(d).cast("int").alias("depth"),
                        F.when(z["at"] > 0, z["at"]).when((d == 0) & ch.isin("}", "]"), i).otherwise(0).cast("int").alias("at"), i.cast("int").alias("i"))

    return F.aggregate(F.split(structure, ""), start, step)


def redact_json(c, secrets=()) -> Column:
    """JSON text of any depth: values under a sensitive key become the marker, at every level and inside lists, other
    strings get url and secret redaction; white space between values goes. Text that is no JSON, or repeats a key in an object, is redacted as
    free text; null stays null.

    One fold over the text's quoted strings and what stands between them, all in the engine: with escaped quotes out of the
    way, every second piece of the text split at quotes is a string. A string before a colon is a key. A value under a sensitive
    key is a string, a bare word, or a container, which is left out up to the bracket that closes it. The fold copies what it has put
    out at each string, so its cost grows with the square of the number of strings in one text.
    """
    known = sorted({s for s in secrets if s}, key=lambda s: (-len(s), s))
    text = _col(c)
    free = redact_secret_values(redact_key_value_text(redact_url_credentials(text)), known)
    hidden = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    marker = F.lit(f'"{REDACTED}"')

    def piece(parts, k):
        """The k-th string with what stands before and after it."""
        inside = F.get(parts, 2 * k + 1)
        after = F.regexp_replace(F.get(parts, 2 * k + 2), r"\s", "")
        key = after.startswith(":")
        clean = redact_secret_values(redact_url_credentials(_decoded(inside)), known)
        shown = F.when(inside.isNull(), "").when(key, F.concat(F.lit('"'), _raw(inside), F.lit('"'))).otherwise(_encoded(clean))
        return F.struct(F.regexp_replace(F.get(parts, 2 * k), r"\s", "").alias("before"), F.coalesce(shown, F.lit("")).alias("shown"),
                        F.coalesce(key & is_sensitive_key(_decoded(inside)), F.lit(False)).alias("sensitive"), inside.isNotNull().alias("string"))

    def step(z, p):
        # below: the piece between strings, then the string after it
        value = F.substring(p["before"], F.lit(2), F.length(p["before"]))  # after a colon
        opens = z["pending"] & value.rlike(r"^[\[{]")
        walk = let(F.when(opens, value).otherwise(p["before"]), lambda s: let(_end_of_container(s, F.when(opens, 0).otherwise(z["muted"])), lambda w: F.struct(
            F.when(w["at"] > 0, F.substring(s, w["at"] + 1, F.length(s))).otherwise("").alias("rest"), F.when(w["at"] > 0, 0).otherwise(w["depth"]).alias("muted"))))

        def go(w):
            bare = z["pending"] & ~opens & (value != "")
            masks = z["pending"] & (value == "")
            between = (F.when(z["muted"] > 0, w["rest"]).when(opens, F.concat(F.lit(":"), marker, w["rest"]))
                       .when(bare, F.concat(F.lit(":"), marker, F.regexp_replace(value, r"^[^,}\]]+", ""))).otherwise(p["before"]))
            muted = F.when((z["muted"] > 0) | opens, w["muted"]).otherwise(0)
            string = F.when((muted > 0) | ~p["string"], "").when(masks, marker).otherwise(p["shown"])
            return F.struct(F.concat(z["out"], F.array(F.concat(between, string))).alias("out"), muted.cast("int").alias("muted"), (p["sensitive"] & (muted == 0) & ~masks).alias("pending"))

        return let(walk, go)

    def fold(parts):
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / 2).cast("int")), lambda k: piece(parts, k))
        start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("muted"), F.lit(False).alias("pending"))
        return F.aggregate(pieces, start, step, lambda z: F.array_join(z["out"], ""))

    return F.when(F.try_parse_json(text).isNotNull(), let(F.split(hidden, '"'), fold)).otherwise(free)


def redact_sensitive_map(c) -> Column:
    """Flat map<string,string>: values under a sensitive key become the marker, others get url redaction (``redact_json``
    is the form for nested values)."""
    return F.transform_values(
        _col(c),
        lambda k, v: F.when(is_sensitive_key(k), F.lit(REDACTED)).otherwise(redact_url_credentials(v)),
    )


_KEY_VALUE_PATTERN = (
    r"(?i)(^|[^A-Za-z0-9_.-])([A-Za-z0-9_.-]*(?:" + "|".join(SENSITIVE_KEY_PARTS) + r")[A-Za-z0-9_.-]*"
    r"[ \t]*[=:][ \t]*)(\"[^\"\n]*\"|'[^'\n]*'|[^ \t\n,;]+)"
)


def redact_key_value_text(c) -> Column:
    """Free text: the value of a ``key = value`` / ``key: value`` pair with a sensitive key becomes the marker."""
    return F.regexp_replace(_col(c), _KEY_VALUE_PATTERN, f"$1$2{REDACTED}")


def url_shape_ok(c) -> Column:
    """Stripped, non-empty and starting with http:// or https://."""
    from vigil.functions.text import strip_ws
    return F.coalesce(strip_ws(_col(c)).rlike(r"^https?://"), F.lit(False))


def key_value_pattern() -> str:
    return _KEY_VALUE_PATTERN
