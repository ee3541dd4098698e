"""The declarative schema that documents are validated against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

ERROR, WARNING, INFO = "error", "warning", "info"


@dataclass(frozen=True)
class FieldSpec:
    """What one field must be like.

    kinds: accepted kinds of value, of str, int, float, bool, list, dict; none: any.
    check: Column -> Column holding a message where the value is bad, null where it is fine.
    """

    name: str
    required: bool = False
    kinds: tuple[str, ...] = ()
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    check: Callable[[Column], Column] | None = None
    weight: float = 1.0


Schema = tuple[FieldSpec, ...]

#: The fields of a case, their limits and weights.
CASE_SCHEMA: Schema = (
    FieldSpec("id", True, ("str",), 1, weight=1.0),
    FieldSpec("title", True, ("str",), 5, weight=1.0),
    FieldSpec("citation", False, ("str",), 3, pattern=r".+\d+.*", weight=0.9),
    FieldSpec("court", False, ("str",), 2, weight=0.8),
    FieldSpec("date", False, ("str",), pattern=r"\d{4}[-/]\d{1,2}[-/]\d{1,2}", weight=0.7),
    FieldSpec("year", False, ("int", "str"), weight=0.7),
    FieldSpec("judges", False, ("list", "str"), weight=0.5),
    FieldSpec("text", True, ("str",), 100, weight=1.0),
    FieldSpec("headnotes", False, ("str", "list"), weight=0.4),
    FieldSpec("statutes_cited", False, ("list", "str"), weight=0.3),
)
#: Columns that are known though they are no field of the schema.
KNOWN_EXTRA = ("_scraped_at",)


def with_field(schema: Schema, spec: FieldSpec) -> Schema:
    return (*schema, spec)


def without_field(schema: Schema, name: str) -> Schema:
    return tuple(s for s in schema if s.name != name)
