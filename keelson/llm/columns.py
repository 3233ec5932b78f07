"""Names for helper columns."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *stems: str) -> list[str]:
    """A name per stem that no column has, upper or lower case."""
    have, out = {t.lower() for t in taken}, []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out
