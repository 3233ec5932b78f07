"""Text and value clean-up: name rules, label maps, safe casts, tag look-ups."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- names kept on the driver -------------------------------------------------

def clean_name(name: str) -> str:
    """Parentheses, blanks and hyphens become underscores; lower case."""
    return re.sub(r"[() -]", "_", name).lower()


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean every name; names that fall together afterwards are an error."""
    seen: dict[str, str] = {}
    for name in names:
        cleaned = clean_name(name)
        if cleaned in seen:
            raise ValueError(f"columns {seen[cleaned]!r} and {name!r} both clean up to {cleaned!r}")
        seen[cleaned] = name
    return list(seen)


def quote_name(*parts: str) -> str:
    """Dotted identifier with each part quoted on its own."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def user_slug(user: str) -> str:
    """X3 and X4 for one driver-side user name."""
    at = user.rfind("@")
    return re.sub(r"\W+", "_", user[:at] if at > 0 else user)


def prefixed(names: Iterable[str], prefix: str) -> list[str]:
    """The names that start with ``prefix``."""
    return [n for n in names if n.startswith(prefix)]


# --- columns ------------------------------------------------------------------

def clean_text(c: str | Column) -> Column:
    """The clean-up of P3 applied to values."""
    return F.lower(F.regexp_replace(_col(c), "[() -]", "_"))


def identifier(c: str | Column) -> Column:
    """Runs of non-word characters become one underscore; letters of any script stay."""
    return F.regexp_replace(_col(c), r"(?U)\W+", "_")


def cut_domain(c: str | Column) -> Column:
    """Cut at the last ``@`` unless it is the first character."""
    return F.regexp_replace(_col(c), r"(?s)^(.+)@[^@]*$", "$1")


def three_level(*parts: str | Column) -> Column:
    """Dotted name from column parts."""
    return F.concat_ws(".", *[_col(p) for p in parts])


def run_name(prefix: str | Column, ts: str | Column) -> Column:
    """Prefix plus a formatted timestamp."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(head, F.date_format(_col(ts), "yyyy-MM-dd_HH:mm:ss"))


def split_list(c: str | Column) -> Column:
    """Comma list to array."""
    return F.split(_col(c), ",", -1)


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """X11: remove a leading prefix only (never an inner occurrence)."""
    column = _col(c)
    return F.when(column.startswith(prefix), F.substr(column, F.lit(len(prefix) + 1))).otherwise(column)


def try_numeric(c: str | Column) -> Column:
    """Number or NULL."""
    return _col(c).try_cast("double")


def value_map(c: str | Column, mapping: Mapping[object, object], dtype: str = "int") -> Column:
    """Dictionary look-up; anything else, NULL included, becomes NULL."""
    column = _col(c)
    out: Column | None = None
    for key, value in mapping.items():
        hit = column == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return (F.lit(None) if out is None else out).cast(dtype)


def tag_lookup(tags: str | Column, key: str, missing: str = "none") -> Column:
    """Map look-up with a default for a missing key."""
    return F.coalesce(F.try_element_at(_col(tags), F.lit(key)), F.lit(missing))


def agrees(prediction: str | Column, label: str | Column) -> Column:
    """1 where prediction equals label, else 0; NULL counts as 0."""
    same = _col(prediction).cast("double") == _col(label).cast("double")
    return F.when(same, F.lit(1)).otherwise(F.lit(0))
