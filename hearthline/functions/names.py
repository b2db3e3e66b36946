"""Column and table names.  Plain Python: it runs on schemas, never on rows."""

from __future__ import annotations

import re
from collections.abc import Iterable


def snake_case(name: str | None) -> str:
    """``Lender Loan #`` -> lender_loan, ``2nd Policy`` -> col_2nd_policy, blank -> col."""
    words = [w for chunk in re.findall("[A-Za-z0-9]+", name or "") for w in _humps(chunk)]
    joined = "_".join(words).lower()
    if not joined:
        return "col"
    return f"col_{joined}" if joined[0].isdigit() else joined


def _humps(chunk: str) -> list[str]:
    """Split where a capital follows a small letter or digit, or starts a word after capitals."""
    cut = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", chunk)
    return re.sub(r"([A-Z])([A-Z][a-z])", r"\1 \2", cut).split()


def unique_names(names: Iterable[str]) -> list[str]:
    """Number repeats ``_1``, ``_2`` ... until the result is really unused.

    Letter case does not tell columns apart in Spark, so it does not here.
    """
    given = list(names)
    reserved = {name.lower() for name in given}
    taken: set[str] = set()
    result = []
    for name in given:
        candidate, n = name, 0
        while candidate.lower() in taken or (n and candidate.lower() in reserved):
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def header_names(headers: Iterable[str | None]) -> list[str]:
    """Unique column names for a header row; blank cells become ``col_{position}``."""
    return unique_names((h or "").strip() or f"col_{i}" for i, h in enumerate(headers))
