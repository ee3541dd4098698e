"""Citation extraction as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.regexes import result_group, unicode_pattern

#: The built-in citation types.
PATTERNS: dict[str, str] = {
    "case_citation": r"\d{4}\s+[A-Z]{2,6}\s+\d+",
    "statute_section": r"[Ss]ection\s+\d+[A-Za-z]?(?:\s*\([a-z0-9]+\))?",
    "article": r"[Aa]rticle\s+\d+[A-Za-z]?(?:\s*\([a-z0-9]+\))?",
    "order_rule": r"[Oo]rder\s+[IVXLCDM]+\s+[Rr]ule\s+\d+",
}


def merged_patterns(custom: Mapping[str, str] | None = None) -> dict[str, str]:
    """The built-in types with custom ones added; a custom type of the same name replaces the built-in one."""
    return {**PATTERNS, **(custom or {})}


def matches(text: Column, pattern: str) -> Column:
    """The distinct matches of one pattern, sorted."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(unicode_pattern(pattern)), F.lit(result_group(pattern)))
    return F.array_sort(F.array_distinct(found))


def extract(text: Column, custom: Mapping[str, str] | None = None) -> Column:
    """map<type, distinct citations> of the types that occur in the text."""
    patterns = merged_patterns(custom)
    whole = F.map_from_arrays(
        F.array(*[F.lit(name) for name in patterns]), F.array(*[matches(text, p) for p in patterns.values()])
    )
    return F.map_filter(whole, lambda _, found: F.size(found) > 0)


def extract_all(text: Column, custom: Mapping[str, str] | None = None) -> Column:
    """All citations of the text; one that two types match is there twice."""
    return F.concat(*[matches(text, p) for p in merged_patterns(custom).values()])
