"""Column names for intermediate results that cannot clash with what a caller brings."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, lengthened by underscores until no column has it; Spark resolves names without regard to case."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
