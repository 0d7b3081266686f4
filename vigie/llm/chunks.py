"""A bounded memory for pieces of text that come again and again within a task."""

from __future__ import annotations

from collections.abc import Callable


def blank_of() -> str:
    """The characters with Unicode's White_Space property, as the inside of a pattern's set."""
    return "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


_KEPT: dict = {}


def kept(make: Callable, *key):
    """One object in a worker process, the last asked for: later tasks go on with what it remembers,
    and what served earlier jobs does not stay beside it."""
    if (make, key) not in _KEPT:
        _KEPT.clear()
        _KEPT[make, key] = make(*key)
    return _KEPT[make, key]


class Remembered:
    """Solves pieces in bulk and keeps the last ``most`` to twice as many answers."""

    def __init__(self, solve: Callable[[list[str]], list], most: int):
        self.solve, self.most = solve, most
        self.new: dict = {}
        self.old: dict = {}

    def get(self, pieces: list[str]) -> list:
        new = self.new
        try:
            return list(map(new.__getitem__, pieces))
        except KeyError:
            pass
        missing = set(pieces).difference(new)
        old, unsolved = self.old, []
        for p in missing:
            if p in old:
                new[p] = old[p]
            else:
                unsolved.append(p)
        if unsolved:
            new.update(zip(unsolved, self.solve(unsolved), strict=True))
        found = list(map(new.__getitem__, pieces))
        if len(new) > self.most:
            self.old, self.new = new, {}
        return found


class RememberedIfMet(Remembered):
    """As before, but what was asked for once does not push out what is asked for again: an answer is
    kept with the last ``most`` to twice as many new ones, and once met again with as many others of its kind."""

    def __init__(self, solve: Callable[[list[str]], list], most: int):
        super().__init__(solve, most)
        self.once: dict = {}
        self.once_before: dict = {}

    def get(self, pieces: list[str]) -> list:
        new, old, once, before = self.new, self.old, self.once, self.once_before
        missing = set(pieces).difference(new)
        unsolved = list(missing.difference(old, once, before))
        for p in missing.difference(unsolved):
            new[p] = old[p] if p in old else (once if p in once else before).pop(p)
        if unsolved:
            once.update(zip(unsolved, self.solve(unsolved), strict=True))
        found = [new[p] if p in new else once[p] for p in pieces]
        if len(new) > self.most:
            self.old, self.new = new, {}
        if len(once) > self.most:
            self.once_before, self.once = once, {}
        return found
