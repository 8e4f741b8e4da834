"""Scalar column expressions for the text rules of the pipeline.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation and is pushed into the scan's stage.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split()/str.strip() treat as
# whitespace (str.isspace), written once as a regex class body that both
# Java regex and RE2 (DuckDB) accept.  Java's own \s is ASCII only.
PY_WHITESPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD_RE = f"[^{PY_WHITESPACE}]+"
STRIP_RE = f"^[{PY_WHITESPACE}]+|[{PY_WHITESPACE}]+$"

# Fixed value: how a missing value prints in a key built from text columns.
MISSING_TEXT = "nan"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(col) -> Column:
    """Whitespace tokens, like Python ``s.split()``; empty array for ''.

    Split on whitespace runs and drop the empty strings a leading or
    trailing run leaves (about 4x faster than extracting every token match).
    """
    return F.array_remove(F.split(_c(col), f"[{PY_WHITESPACE}]+", -1), "")


def word_count(col) -> Column:
    """``len(s.split())`` as an int; 0 for the empty string, null for null."""
    return F.size(words(col)).cast("int")


def py_strip(col) -> Column:
    """Python ``s.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(_c(col), STRIP_RE, "")


def basename(col) -> Column:
    """Last ``/``-separated segment (``os.path.basename`` on a URL path)."""
    return F.substring_index(_c(col), "/", -1)


def file_stem(col, suffix: str = ".pdf") -> Column:
    """Basename with every case-sensitive occurrence of ``suffix`` removed."""
    return F.replace(basename(col), F.lit(suffix), F.lit(""))


def absolutize_url(col, base_url: str) -> Column:
    """``base + link`` when the link starts with ``/``, else the link as is."""
    c = _c(col)
    return F.when(c.startswith("/"), F.concat(F.lit(base_url), c)).otherwise(c)


def strip_label(col, label: str) -> Column:
    """Remove every occurrence of a literal label; the rest is not re-trimmed."""
    return F.replace(_c(col), F.lit(label), F.lit(""))


def text_or_missing(col) -> Column:
    """A value as it prints inside a concatenated key; null becomes ``nan``."""
    return F.coalesce(_c(col).cast("string"), F.lit(MISSING_TEXT))


def concat_key(*cols) -> Column:
    """Key of several columns joined with no separator, missing -> ``nan``."""
    return F.concat(*[text_or_missing(c) for c in cols])


def _hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    block = 64  # SHA-256 block size
    if len(key) > block:
        key = hashlib.sha256(key).digest()
    key = key.ljust(block, b"\x00")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def keyed_hash(col, key: str | bytes) -> Column:
    """HMAC-SHA256 of the UTF-8 text as lower-case hex, built from ``sha2``.

    The key is a job parameter; its inner and outer pads are computed once on
    the driver and enter the plan as binary literals.
    """
    kb = key.encode("utf-8") if isinstance(key, str) else bytes(key)
    ipad, opad = _hmac_pads(kb)
    inner = F.sha2(F.concat(F.lit(ipad), F.encode(_c(col), "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(opad), F.unhex(inner)), 256)


def hmac_pad_hex(key: str | bytes) -> tuple[str, str]:
    """The two pads as hex, for writing the same hash in SQL."""
    kb = key.encode("utf-8") if isinstance(key, str) else bytes(key)
    ipad, opad = _hmac_pads(kb)
    return ipad.hex(), opad.hex()
