"""Encoding by distinct words inside a task: each word is merged once and its ids are kept as bytes."""

from __future__ import annotations

from collections.abc import Callable


class WordCache:
    """Two generations of at most ``limit`` words each: words still in use move to the young one, the rest is forgotten.

    ``encode`` turns a list of distinct words into a list of values of the same length. Memory is bounded by ``limit``; the
    results never depend on it.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def fill(self, words: set[str]) -> dict[str, object]:
        """A dict that holds every word of ``words``."""
        new = words.difference(self.young)
        if len(self.young) + len(new) > self.limit and self.young:
            self.old, self.young = self.young, {}
            new = words
        missing = []
        for w in new:
            v = self.old.get(w)
            if v is None:
                missing.append(w)
            else:
                self.young[w] = v
        if missing:
            self.young.update(zip(missing, self.encode(missing), strict=True))
        return self.young
