"""Units of texts: leading white space with the word after it, or a text's last
white space alone (``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, matched
left to right). Units cover a text without gaps, so they're given by their starts."""

from __future__ import annotations

import numpy as np

from ._flat import SEPARATOR, Texts


def unit_starts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all units, and where each text's units begin among them.

    UTF-8 doesn't use the separators' bytes inside a longer character, so bytes
    and code points have the same units.
    """
    space = SEPARATOR[texts.data]
    start = np.zeros(len(texts.data) + 1, dtype=bool)
    start[1:-1] = space[1:] & ~space[:-1]
    start[texts.offsets[:-1]] = True  # an empty text's start is another text's or the end
    starts = np.flatnonzero(start[:-1])
    return starts, np.searchsorted(starts, texts.offsets)
