"""What a Python worker keeps between tasks: the state of one operator at a time.

Workers are used again by later stages, so the tables of an operator whose turn is
over are dropped (and their memory handed back) when the next one builds its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

T = TypeVar("T")
_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        _HELD[key] = make()
    return _HELD[key]  # type: ignore[return-value]
