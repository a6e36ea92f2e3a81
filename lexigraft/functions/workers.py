"""State that a Python worker keeps between tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any


def per_worker(kind: str, key: Any, make: Callable[[], Any]) -> Any:
    """``make()`` once per worker process and key; the last few keys of a kind are kept."""
    kept = sys.__dict__.setdefault("_lexigraft_kept", {}).setdefault(kind, {})
    if key not in kept:
        while len(kept) >= 4:
            kept.pop(next(iter(kept)))
        kept[key] = make()
    return kept[key]
