"""Times as whole numbers."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def millis(when: datetime) -> int:
    """Whole milliseconds since 1970, rounded down, without floating point; a time without a zone is local."""
    return (when.astimezone(UTC) - _EPOCH) // timedelta(milliseconds=1)
