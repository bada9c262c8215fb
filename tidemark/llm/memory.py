"""What a reused Python worker keeps from one task to the next, and when it gives that back.

An operator that remembers results between its tasks registers how to drop them. Tasks of any other operator call
``begin`` first, so a long job never pays for the memory of its earlier stages.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_KEPT: dict[str, Callable[[], None]] = {}


def keep(owner: str, drop: Callable[[], None]) -> None:
    """From now on this worker holds something for the tasks of ``owner``; ``drop`` gives it back."""
    _KEPT[owner] = drop


def begin(owner: str | None = None) -> None:
    """A task of ``owner`` starts: what was kept for others goes, and unused Arrow memory along with it."""
    for other in [o for o in _KEPT if o != owner]:
        _KEPT.pop(other)()
    pa.default_memory_pool().release_unused()
