"""Pieces of the SQL that states the queries' results."""

from __future__ import annotations


def stripped(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def single_blanks(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def normal_text(x: str) -> str:
    return single_blanks(f"lower({stripped(x)})")


def normal_sql(x: str) -> str:
    text = stripped(f"regexp_replace(lower({stripped(x)}), ';+$', '')")
    bare = rf"regexp_replace({text}, '(''(?:[^'']|'''')*'')|--[^\n]*|/\*(?:[^*]|\*[^/])*\*/', '\1', 'g')"
    return stripped(single_blanks(bare))
