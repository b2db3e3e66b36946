"""Column policies for sensitive data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Borrower columns flagged sensitive in the document model.
SENSITIVE = ("ssn", "dateOfBirth", "email", "primaryPhoneNumber", "homePhoneNumber", "workPhoneNumber")


def apply_policy(df: DataFrame, policy: Mapping[str, str], salt: str = "") -> DataFrame:
    """``{column: action}`` with actions drop, null, mask, last4 and hash.

    ``hash`` is SHA-256 over salt and value, so equal values still join.
    """
    def treated(c: Column, action: str) -> Column:
        value = c.cast("string")
        if action == "null":
            return F.lit(None).cast("string")
        if action == "mask":
            return F.mask(value)
        if action == "last4":
            return F.concat(F.lit("***"), F.right(value, F.lit(4)))
        if action == "hash":
            return F.sha2(F.concat(F.lit(salt), value), 256)
        raise ValueError(f"unknown action {action!r}")

    known = {c: a for c, a in policy.items() if c in df.columns}
    kept = df.drop(*[c for c, a in known.items() if a == "drop"])
    changed = {c: treated(F.col(c), a) for c, a in known.items() if a != "drop"}
    return kept.withColumns(changed) if changed else kept
