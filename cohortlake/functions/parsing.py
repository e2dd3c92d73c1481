"""Parsing that yields null, never an error, for values that do not conform."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_boolean(text: Column) -> Column:
    """true and false in any case; anything else, also 1 and yes, is null."""
    low = F.lower(text)
    return F.when(low.isin("true", "false"), low == "true")


def to_number(text: Column, kind: str) -> Column:
    return text.try_cast(kind)


def to_date(text: Column) -> Column:
    """yyyy-M-d."""
    return F.try_to_date(text, "yyyy-M-d")


def to_instant(text: Column) -> Column:
    """ISO 8601 date and time with none or up to six fraction digits; a bare date is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"), F.try_to_timestamp(F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


def records(text: Column, fields: dict[str, tuple[str, str | None]]) -> Column:
    """A JSON array of objects as an array of structs; null, malformed text and anything but an array are an empty array.

    fields: name -> (path with at most one dot, type to cast to or null for text).
    """
    tree: dict[str, list[str]] = {}
    for path, _ in fields.values():
        head, _, tail = path.partition(".")
        tree.setdefault(head, []).extend([tail] if tail else [])
    leaves = ", ".join(f"{head}: " + (f"STRUCT<{', '.join(f'{t}: STRING' for t in tails)}>" if tails else "STRING") for head, tails in tree.items())
    parsed = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"ARRAY<STRUCT<{leaves}>>"))

    def one(x: Column) -> Column:
        got = {name: (_leaf(x, path), kind) for name, (path, kind) in fields.items()}
        return F.struct(*[(c.try_cast(kind) if kind else c).alias(name) for name, (c, kind) in got.items()])

    return F.coalesce(F.transform(parsed, one), F.transform(F.array().cast("array<struct<" + ", ".join(f"{h}: " + (f"struct<{', '.join(f'{t}: string' for t in ts)}>" if ts else "string") for h, ts in tree.items()) + ">>"), one))


def _leaf(x: Column, path: str) -> Column:
    for name in path.split("."):
        x = x[name]
    return x


def mask_first(query: Column, clause: Column, mark: str = "*") -> Column:
    """query with the first occurrence of clause replaced by the mark; unchanged without one."""
    at = F.position(clause, query)
    return F.when((at > 0) & (F.length(clause) > 0), F.concat(F.substring(query, F.lit(1), at - 1), F.lit(mark), F.substring(query, at + F.length(clause), F.length(query)))).otherwise(query)
