"""What a Python worker keeps between tasks: one thing, as long as its tasks ask for that."""

from __future__ import annotations

from collections.abc import Callable

from tallyworks.llm.shingles import give_back

_KEPT: dict[tuple, object] = {}


def kept(make: Callable, *key: str):
    """``make(*key)``, made by the first of the tasks that ask for it."""
    if (make, *key) not in _KEPT:
        let_go()
        _KEPT[make, *key] = make(*key)
    return _KEPT[make, *key]


def let_go() -> None:
    """Free what is kept, for a task that needs the memory for something else."""
    if _KEPT:
        _KEPT.clear()
        give_back()
