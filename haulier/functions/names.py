"""Identifier quoting and exact-case column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import SchemaError

# Opening quote, closing quote, escaped closing quote.
QUOTES = {
    "postgresql": ('"', '"', '""'),
    "sqlserver": ("[", "]", "]]"),
    "spark": ("`", "`", "``"),
}


def quote_ident(name: str, dialect: str = "spark") -> str:
    """Quote one identifier for the given SQL dialect."""
    opening, closing, escaped = QUOTES[dialect]
    return opening + name.replace(closing, escaped) + closing


def column(name: str) -> Column:
    """Column reference that also works for names such as ``$data_ingestao`` or ``a.b``."""
    return F.col(quote_ident(name))


def require_column(columns: Iterable[str], name: str | None, role: str) -> str:
    """Return the trimmed name if it exists with exactly this case."""
    wanted = (name or "").strip()
    if not wanted:
        raise SchemaError(f"{role} must name a column")
    present = list(columns)
    if wanted not in present:
        raise SchemaError(f"{role} '{wanted}' is not a column of the source; columns: {present}")
    return wanted


def clashes(columns: Iterable[str], names: Iterable[str]) -> list[str]:
    """Names that Spark would confuse with an existing column (it ignores case)."""
    present = {c.lower() for c in columns}
    return [n for n in names if n.lower() in present]
