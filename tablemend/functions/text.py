"""Helpers for names, blank texts and relative paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators U+001C..U+001F, which
# Unicode's White_Space property leaves out.
_NOT_BLANK = r"(?U)[^\s\x1C-\x1F]"


def quoted(name: str) -> str:
    """A column's exact name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col(quoted(name))


def has_text(value: Column) -> Column:
    """True where a text is neither NULL nor only white space."""
    return F.coalesce(value.rlike(_NOT_BLANK), F.lit(False))


def is_safe_path(path: Column) -> Column:
    """True for a relative path that stays below its base folder."""
    absolute = path.startswith("/") | path.startswith("\\") | path.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*://|[A-Za-z]:[/\\])")
    return ~(absolute | path.rlike(r"(^|[/\\])\.\.([/\\]|$)"))


def below(base: str, path: Column) -> Column:
    """Base folder plus relative path; NULL where the path would leave the base."""
    return F.when(is_safe_path(path), F.concat(F.lit(base.rstrip("/") + "/"), path))
