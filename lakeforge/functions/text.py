"""Small text helpers outside Spark."""
from __future__ import annotations

LOW, HIGH = 32, 126  # printable ASCII


def shifted(text: str, by: int) -> str:
    """Each printable ASCII character moved within that range; others stay. A format, not a way to keep secrets."""
    span = HIGH - LOW + 1
    return "".join(chr((ord(c) - LOW + by) % span + LOW) if LOW <= ord(c) <= HIGH else c for c in text)


def unshifted(text: str, by: int) -> str:
    return shifted(text, -by)
