"""Which errors of a block source are worth a retry, and which mean that a block isn't there yet.

The needles are fixed values: they are the texts that nodes and HTTP clients use.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

T = TypeVar("T")

TEMPORARY = ("connection refused", "connection reset", "timeout", "temporarily unavailable", "i/o timeout", "eof", "http 502", "http 503", "http 504", "http 429")
FINAL = ("http 400", "http 401", "http 403", "http 404")
CANCELLED = ("context canceled", "context deadline exceeded")
UNAVAILABLE = ("failed to retrieve information from the ledger", "round not available", "not found", "lookup failed", "errnoentry", "404")
FINAL_STATUS = frozenset((400, 401, 403, 404))
RETRY_STATUS = frozenset((408, 429, 500, 502, 503, 504))

#: (message, retryable, unavailable): cases for the query and the tests.
RETRY_CASES = (
    ("connection refused", True, False), ("HTTP 503: busy", True, False), ("HTTP 404: no such block", False, True), ("HTTP 401", False, False),
    ("unexpected EOF", True, False), ("round not available yet", True, True), ("context canceled", False, False), ("context deadline exceeded", False, False), ("strange", True, False),
)


class SourceError(Exception):
    """An error of a block source, with its HTTP status if it has one."""

    def __init__(self, message: str, status: int | None = None) -> None:
        super().__init__(message)
        self.status = status


def retryable(error: BaseException | None) -> bool:
    if error is None or isinstance(error, KeyboardInterrupt):
        return False
    status = getattr(error, "status", None)
    if status in FINAL_STATUS:
        return False
    if status in RETRY_STATUS or isinstance(error, ConnectionError | TimeoutError):
        return True
    text = str(error).lower()
    if any(t in text for t in CANCELLED):
        return False
    return any(t in text for t in TEMPORARY) or not any(t in text for t in FINAL)


def unavailable(error: BaseException) -> bool:
    text = str(error).lower()
    return any(t in text for t in UNAVAILABLE)


def _any(text: Column, needles: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(text, F.lit(n))
    return out


def retryable_column(message: Column) -> Column:
    text = F.lower(message)
    return F.coalesce(~_any(text, CANCELLED) & (_any(text, TEMPORARY) | ~_any(text, FINAL)), F.lit(False))


def unavailable_column(message: Column) -> Column:
    return F.coalesce(_any(F.lower(message), UNAVAILABLE), F.lit(False))


def with_retry(call: Callable[[], T], first: float = 0.5, most: float = 30.0, attempts: int | None = None, sleep: Callable[[float], None] = time.sleep) -> T:
    """Call until it succeeds or fails for good, waiting twice as long after each failure, up to ``most`` seconds."""
    wait, n = first, 0
    while True:
        try:
            return call()
        except Exception as e:
            n += 1
            if not retryable(e) or (attempts is not None and n >= attempts):
                raise
            sleep(min(wait, most) * (0.9 + 0.2 * random.random()))
            wait = min(wait * 2, most)
