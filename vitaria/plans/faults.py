"""Which of many parts make a job fail, found by testing groups of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

Part = TypeVar("Part")
#: When so many groups are tested at once and not one passes, the fault lies elsewhere.
HOPELESS = 16


def failing_parts(
    parts: Sequence[Part], test: Callable[[Sequence[Part]], Exception | None], threads: int = 4
) -> dict[Part, Exception]:
    """The parts that fail by themselves, each with its error.

    A group that fails is halved, and both halves are tested side by side; a group that passes
    is done with. A few bad parts among n take about ``2 * log2(n)`` tests each. Where
    every group of a large round fails, the error of the first is raised: it then concerns all parts.
    """
    bad: dict[Part, Exception] = {}
    groups = [list(parts)] if parts else []
    while groups:
        with ThreadPoolExecutor(threads) as pool:
            errors = list(pool.map(test, groups))
        if len(groups) >= HOPELESS and all(errors):
            raise errors[0]
        halves: list[list[Part]] = []
        for group, error in zip(groups, errors, strict=True):
            if error is None:
                continue
            if len(group) == 1:
                bad[group[0]] = error
            else:
                halves += [group[: len(group) // 2], group[len(group) // 2 :]]
        groups = halves
    return bad
