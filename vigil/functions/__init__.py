"""Column expressions (JVM-side, whole-stage-codegen friendly); no Python UDFs."""

from vigil.functions.parse import (  # noqa: F401
    MISSING_TOKENS, is_missing_token, numeric_or_null, looks_numeric, truthy, split_list,
    empty_to_null, none_label,
)
from vigil.functions.text import (  # noqa: F401
    WHITESPACE_CLASS, strip_ws, squeeze_ws, char_entropy, char_ngrams, text_length,
)
from vigil.functions.redact import (  # noqa: F401
    REDACTED, SENSITIVE_KEY_PARTS, redact_url_credentials, redact_secret_values,
    is_sensitive_key, redact_sensitive_map, redact_key_value_text, url_shape_ok,
)
