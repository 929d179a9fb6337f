"""What a Python worker keeps between tasks: the state of one operator, within a number of bytes."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import Any

#: Bytes of answers that a worker keeps. Workers are reused by later stages.
KEPT_BYTES = 32 << 20
#: Keys of more characters are never kept.
LONG_KEY = 64
_ENTRY = 200  # bytes of an entry besides its characters

_state: tuple[Hashable, Any] | None = None


def worker_state(owner: Hashable, make: Callable[[], Any]) -> Any:
    """The state of an operator in this worker; that of any other operator is dropped first."""
    global _state
    if _state is None or _state[0] != owner:
        _state = None
        _state = (owner, make())
    return _state[1]


class Kept:
    """Answers by key, at most ``limit`` bytes of them.

    Answers stand in two generations. When the newer one holds half of the bytes, it becomes the
    older one, which is dropped; a key that is asked for moves to the newer.
    """

    def __init__(self, limit: int = KEPT_BYTES):
        self.limit = limit
        self.newer: dict = {}
        self.older: dict = {}
        self.bytes = 0
        self.long: list = []

    def _put(self, keys: list, answers: list) -> None:
        self.newer.update(zip(keys, answers))
        self.long += [k for k in keys if len(k) > LONG_KEY]
        self.bytes += _ENTRY * len(keys) + sum(map(len, keys))
        if answers and isinstance(answers[0], bytes):
            self.bytes += sum(map(len, answers))

    def table(self, wanted: set, answer: Callable[[list], Iterable]) -> dict:
        """A table with the answers of all ``wanted`` keys; ``answer`` is asked for new ones. It holds
        until the next call."""
        for key in self.long:
            gone = self.newer.pop(key)
            self.bytes -= _ENTRY + len(key) + (len(gone) if isinstance(gone, bytes) else 0)
        self.long = []
        if 2 * self.bytes > self.limit:
            self.newer, self.older, self.bytes = {}, self.newer, 0
        new = wanted.difference(self.newer)
        unknown = new.difference(self.older)
        if len(unknown) < len(new):
            again = list(new - unknown)
            self._put(again, [self.older[k] for k in again])
        fresh = list(unknown)
        for at in range(0, len(fresh), 4096):
            part = fresh[at : at + 4096]
            self._put(part, list(answer(part)))
        return self.newer
