"""Column-list helper shared by the keyed operators."""

from __future__ import annotations

from collections.abc import Iterable


def column_list(names: str | Iterable[str]) -> list[str]:
    """Key columns as a list; one name may be given as a plain string."""
    if isinstance(names, str):
        names = (names,)
    return list(names)
