"""Keeps matrix products on the core that Spark gave to the task."""

from __future__ import annotations

import ctypes
from functools import cache
from pathlib import Path

import numpy as np

#: Names that builds of OpenBLAS give the call that sets the number of threads.
SETTERS = ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads",
           "openblas_set_num_threads64_", "openblas_set_num_threads")


@cache
def one_thread() -> bool:
    """Sets numpy's OpenBLAS to one thread; whether it was found.

    Threads of small products mostly wait for each other, on cores that other tasks use.
    """
    root = Path(np.__file__).parent
    found = False
    for path in [*root.parent.glob("numpy.libs/*openblas*"), *root.glob(".libs/*openblas*")]:
        try:
            library = ctypes.CDLL(str(path))
        except OSError:
            continue
        for name in SETTERS:
            if hasattr(library, name):
                getattr(library, name)(1)
                found = True
    return found
