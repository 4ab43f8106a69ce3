"""Text column expressions.

Python's ``str.split()``/``strip()`` treat 29 code points as whitespace; the
JVM's ``\\s`` covers only six of them, so an explicit class is used everywhere a
"whitespace" decision is made.  ``splitlines`` likewise breaks on more than
``\\n``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python treats as whitespace, and the line
# boundaries of str.splitlines().
WS_CLASS = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# Word tokens: two or more Unicode word characters (so "_" compounds stay whole).
WORD_TOKEN = r"(?U)\b\w\w+\b"
# Notebook tokens: one or more word characters.
WORD_TOKEN_ANY = r"(?U)\b\w+\b"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), rf"^{WS_CLASS}+|{WS_CLASS}+$", "")


def clean_text(c, lowercase: bool = True) -> Column:
    """Strip, optionally lowercase, collapse whitespace runs to one space."""
    x = _c(c)
    if lowercase:
        x = F.lower(x)
    return F.trim(F.regexp_replace(x, f"{WS_CLASS}+", " "))


def ws_tokens(c) -> Column:
    """``str.split()``: whitespace tokens, empties dropped."""
    return F.filter(F.split(_c(c), f"{WS_CLASS}+"), lambda t: t != F.lit(""))


def word_tokens(c, pattern: str = WORD_TOKEN) -> Column:
    """Lower-cased word tokens matched by ``pattern`` (array<string>)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(pattern), 0)


def split_lines(c) -> Column:
    """``str.splitlines()`` (may contain a trailing empty element)."""
    return F.split(_c(c), LINE_BREAK)
