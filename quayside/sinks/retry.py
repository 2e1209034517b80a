"""K9: retries with exponential backoff around a batch's write."""

from __future__ import annotations

import time
from collections.abc import Callable

from quayside.constants import BULK_MAX_RETRIES, BULK_RETRY_WAIT


def seconds(text: str) -> float:
    """``500ms``, ``1s``, ``2min`` in seconds."""
    for unit, factor in (("ms", 0.001), ("min", 60.0), ("s", 1.0)):
        if text.endswith(unit):
            return float(text[:-len(unit)]) * factor
    raise ValueError(f"not a duration: {text!r}")


def waits(retries: int = BULK_MAX_RETRIES, first: float = seconds(BULK_RETRY_WAIT), longest: float | None = None) -> list[float]:
    """Seconds before each retry: the first wait, then twice the one before, at most ``longest``."""
    return [min(first * 2**i, longest) if longest is not None else first * 2**i for i in range(retries)]


def with_backoff(write: Callable, retries: int = BULK_MAX_RETRIES, first: float = seconds(BULK_RETRY_WAIT), longest: float | None = None,
                 fatal: tuple[type[BaseException], ...] = (), sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``write`` tried again after each failure but those in ``fatal``; when all retries are used up the last
    failure is raised, which fails the batch and so the query, and a restart begins with that batch.
    The write has to be idempotent (documents by id, a batch's own partition)."""

    def run(*args, **kwargs):
        for wait in [*waits(retries, first, longest), None]:
            try:
                return write(*args, **kwargs)
            except fatal:
                raise
            except Exception:
                if wait is None:
                    raise
                sleep(wait)

    return run
