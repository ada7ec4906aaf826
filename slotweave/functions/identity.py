"""Name-based UUIDs (RFC 9562, version 5) as native expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def namespace_uuid(namespace: str) -> uuid.UUID:
    """The namespace as a UUID; other text is first named under the URL namespace."""
    try:
        return uuid.UUID(namespace)
    except ValueError:
        return uuid.uuid5(uuid.NAMESPACE_URL, namespace)


def uuid5(namespace: str, name: Column) -> Column:
    """``uuid.uuid5(namespace, name)`` for every row, null for a null name."""
    prefix = F.unhex(F.lit(namespace_uuid(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    # The variant bits are binary 10, so the digit keeps only its two low bits.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )
