"""Token ids of texts by way of their distinct words.

A text's ids are the ids of its words in a row, so each task encodes a word the first time
it meets it and afterwards joins stored byte strings. The store holds two generations:
when the young one passes its bounds the old one is dropped, and a word met again moves to
the young one. Forgetting costs time and never changes ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

MAX_WORDS = 150_000
MAX_CHARS = 16 << 20


class WordIds:
    """``encode(words)`` returns the ids of each of the new words as bytes. A
    generation holds about ``most`` words."""

    def __init__(self, encode: Callable[[list], Iterable[bytes]], most: int = MAX_WORDS):
        self.encode, self.most, self.known, self.old, self.chars = encode, most, {}, {}, 0

    def learn(self, words: set) -> None:
        """Make ``ids`` ready for texts made of ``words``."""
        if len(self.known) > self.most or self.chars > MAX_CHARS:
            self.old, self.known, self.chars = self.known, {}, 0
        known, old = self.known, self.old
        new = words.difference(known)
        self.chars += sum(map(len, new))
        again = new.intersection(old)
        known.update((w, old[w]) for w in again)
        new = list(new - again)
        known.update(zip(new, self.encode(new)))

    def ids(self, words: list) -> bytes:
        return b"".join(map(self.known.__getitem__, words))
