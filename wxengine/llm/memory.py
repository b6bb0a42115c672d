"""Memory of long-lived Python workers.

A worker serves one task after another, of this and of later stages, and what a task has freed
stays with the allocators, per worker up to a few hundred megabytes of an executor's memory.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)
