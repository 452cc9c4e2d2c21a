"""A bounded memo for per-word results inside a Python worker."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """word -> result. Two generations of at most `limit` entries: when the young one is full it becomes the
    old one, and entries of the old one move back when they are used, so that frequent words stay. Words
    over `longest` characters are not kept."""

    def __init__(self, compute: Callable[[str], bytes], limit: int, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if (result := self.old.get(word)) is None:
            result = self.compute(word)
        if len(word) <= self.longest:
            self[word] = result
        return result

    def join(self, words: list[str]) -> bytes:
        """The words' results, joined."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, words))

    def known(self, word: str) -> bool:
        return word in self or word in self.old
