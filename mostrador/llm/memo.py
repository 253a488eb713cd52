"""A bounded memory of results per word, kept by each Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence


class Memo:
    """Results of ``compute`` for the last ``limit`` to ``2 * limit`` keys asked for.

    ``compute`` gets all unknown keys of a request at once and returns their results
    in order. There are two generations: when the young one is full it becomes the
    old one, and keys of the old one that are asked for again move over. Memory is
    bounded whatever the text, and frequent words stay.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable[bytes]], limit: int = 180_000) -> None:
        self._compute, self._limit = compute, limit
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def joined(self, lists: Sequence[list[str]]) -> list[bytes]:
        """For each list of keys, its results put together."""
        passing = self._ask(set().union(*lists))
        known = self._young.__getitem__
        out = [b"".join(map(known, keys)) for keys in lists]
        self._forget(passing)
        return out

    def results(self, keys: list[str]) -> list[bytes]:
        """The result of each key."""
        out = list(map(self._young.get, keys))
        missing = [place for place, value in enumerate(out) if value is None]
        passing = self._ask({keys[place] for place in missing})
        for place in missing:
            out[place] = self._young[keys[place]]
        self._forget(passing)
        return out

    def _ask(self, keys: set[str]) -> list[str]:
        """Put all keys among the young; returns those too long to be kept."""
        young, passing = self._young, []
        unknown = keys.difference(young)
        if unknown:
            young.update((key, self._old[key]) for key in unknown & self._old.keys())
            new = list(unknown - young.keys())
            for key, value in zip(new, self._compute(new)):
                young[key] = value
                if len(key) > 64:
                    passing.append(key)
        return passing

    def _forget(self, passing: list[str]) -> None:
        for key in passing:
            del self._young[key]
        if len(self._young) >= self._limit:
            self._old, self._young = self._young, {}
