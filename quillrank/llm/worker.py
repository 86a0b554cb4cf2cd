"""What a Python worker keeps between tasks: tokenizers and their caches."""

import ctypes
import gc
import sys
import types
from collections.abc import Callable
from typing import Any

_HOME = "quillrank_worker_state"


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """The value under ``key`` of this process, made on first use.

    Functions of this package travel by value, so their own globals are new in every task; this
    module stays in the process.
    """
    home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
    if key not in home.__dict__:
        home.__dict__[key] = make()
    return home.__dict__[key]


def keep_only(*starts: str) -> None:
    """Forget what this process keeps under keys that start otherwise.

    Workers serve one operator after the other; the next one should not pay for the caches of the last.
    """
    home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
    gone = [k for k in home.__dict__ if not k.startswith(("__", *starts))]
    for key in gone:
        del home.__dict__[key]
    if gone:
        give_back()


def give_back() -> None:
    """Return freed memory to the system, at the end of a task: an idle worker stays as large as its last task made it."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it has its own way
