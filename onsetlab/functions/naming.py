"""Feature column names made from free-text category names."""

from __future__ import annotations

import re
from collections.abc import Sequence


def feature_names(prefix: str, categories: Sequence[str]) -> dict[str, str]:
    """Map each category to a column name that is safe and unique.

    Names compare case-insensitively in Spark and in most catalogs, so they are
    lower-cased; categories that end up alike get a number. The result does not
    depend on the order in which categories are given.
    """
    names: dict[str, str] = {}
    taken: set[str] = set()
    for category in sorted(set(categories)):
        stem = prefix + re.sub(r"[^0-9a-z]+", "_", category.lower()).strip("_")
        name, number = stem, 2
        while name in taken:
            name, number = f"{stem}_{number}", number + 1
        taken.add(name)
        names[category] = name
    return names
