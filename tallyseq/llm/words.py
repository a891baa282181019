"""The word rule that the text operators share: lower-case A-Z only, words are runs of bytes other than
the six ASCII white-space characters. bytes.lower and bytes.split do exactly that."""

from __future__ import annotations

#: The same rule as a regular expression, for Spark SQL and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; null gives none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
