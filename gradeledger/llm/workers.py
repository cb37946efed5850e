"""What Python workers keep from task to task.

Spark uses a worker again for tasks of other stages, so tables and hashes that one operator
keeps there would lie beside those of every operator after it. A task says whose it is when
it begins, and what the others keep is let go of.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_FORGET: dict[str, Callable[[], None]] = {}
_OWNER: list[str] = []


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """Says how to let go of what the tasks of ``owner`` keep."""
    _FORGET[owner] = forget


def begin(owner: str) -> None:
    """First call of a task of ``owner``. Costs something only where the worker's last task
    was another's."""
    if _OWNER == [owner]:
        return
    _OWNER[:] = [owner]
    for other, forget in _FORGET.items():
        if other != owner:
            forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
    if trim is not None:
        trim(0)
