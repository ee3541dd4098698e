"""Patterns in the dialect of Java's regular expressions."""

from __future__ import annotations

import re


def unicode_pattern(pattern: str, ignore_case: bool = False) -> str:
    r"""The pattern with \w, \s, \d and \b over all of Unicode, as Python's are."""
    return ("(?iuU)" if ignore_case else "(?U)") + pattern


def result_group(pattern: str) -> int:
    """Which group a list of matches holds: the whole match without groups, the group if there is one."""
    groups = re.compile(pattern).groups
    if groups > 1:
        raise ValueError(f"at most one capturing group is supported: {pattern!r}")
    return groups
