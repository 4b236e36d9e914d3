"""Terms of whole texts, by NumPy over Arrow's own buffers.

A term is a maximal run of ASCII letters, digits and characters outside ASCII. Text is
taken as UTF-8 bytes: every byte of a character outside ASCII is 128 or more.
"""

from __future__ import annotations

import numpy as np

_TERM = np.zeros(256, dtype=bool)
_TERM[128:] = True
for _low, _high in ("09", "AZ", "az"):
    _TERM[ord(_low) : ord(_high) + 1] = True


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in ``data``; no term crosses from one text to the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = _TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
