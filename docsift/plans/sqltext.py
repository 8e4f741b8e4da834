"""SQL text fragments shared by the DuckDB oracle queries.

The oracle is independent of the Spark plans: it restates each rule in plain
SQL over the registered views, so a match means both engines agree.
"""

from __future__ import annotations

from docsift.functions.text import PY_WHITESPACE

WORD = f"'[^{PY_WHITESPACE}]+'"
STRIP = f"'^[{PY_WHITESPACE}]+|[{PY_WHITESPACE}]+$'"


def words(expr: str) -> str:
    return f"regexp_extract_all({expr}, {WORD})"


def word_count(expr: str) -> str:
    return f"len({words(expr)})"


def py_strip(expr: str) -> str:
    return f"regexp_replace({expr}, {STRIP}, '', 'g')"


def bucket(tok: str, dim: int) -> str:
    return f"(('0x' || substr(md5({tok}), 1, 4))::INTEGER % {dim})"


def line_chunks(source: str = "documents") -> str:
    """(doc_id, chunk_no, chunk) for every line of every document."""
    return (
        "SELECT doc_id, unnest(p) AS chunk, generate_subscripts(p, 1) AS chunk_no "
        f"FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM {source} WHERE text IS NOT NULL)"
    )


def term_counts(rel: str, key: str, text: str, dim: int) -> str:
    """(key..., dim, n) hashed term counts of a text column of ``rel``."""
    return (
        f"SELECT {key}, {bucket('tok', dim)} AS dim, count(*) AS n FROM "
        f"(SELECT {key}, unnest({words(f'lower({text})')}) AS tok FROM ({rel})) "
        f"GROUP BY ALL"
    )
