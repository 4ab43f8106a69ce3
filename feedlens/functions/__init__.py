"""Column expressions shared by the operators (all JVM-side built-ins)."""
from .text import (  # noqa: F401
    WS_CLASS,
    LINE_BREAK,
    WORD_TOKEN,
    clean_text,
    strip_ws,
    ws_tokens,
    word_tokens,
    split_lines,
)
from .parse import parse_response  # noqa: F401
from .vectors import dot, l2_norm, euclidean, cosine_sim, to_double_array  # noqa: F401
from .hashing import md5_int32, md5_bucket, md5_sign  # noqa: F401
