"""Scalar column functions (all JVM-side built-in expressions)."""

from kestrel.functions.scalars import (  # noqa: F401
    blank_to_null_double,
    category_offset,
    gender_code,
    jvm_split_space,
    jvm_trim,
    nan_to_null,
    null_to_zero,
    parse_int_strict,
    question_to_null,
    split_first_tab,
    str_len,
    strip_quotes,
)
from kestrel.functions.hashing import (  # noqa: F401
    hash_bucket,
    hash_fraction,
    jvm_string_hash,
    non_negative_mod,
)
