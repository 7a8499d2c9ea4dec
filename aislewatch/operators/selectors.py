"""Selectors in the common notation: ``div.card[data-x*='y'] > a, #id``.

A selector compiles to paths of steps. ``matches`` walks a parsed page with them; ``structure.select_rows``
turns the same steps into joins over element rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

_STEP = re.compile(r"\s*([>+~]|\s)\s*|([\w-]+|\*)|#([\w-]+)|\.([\w-]+)|\[([^\]]*)\]")
_TEST = re.compile(r"""\s*([\w-]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\s]*))\s*(i)?)?\s*$""")


@dataclass(frozen=True)
class Test:
    """One attribute test; ``op`` is empty (present), ``=``, ``*=``, ``^=``, ``$=`` or ``~=``."""

    name: str
    op: str = ""
    value: str = ""
    fold: bool = False

    def holds(self, attrs: Mapping[str, str]) -> bool:
        held = attrs.get(self.name)
        if held is None or not self.op:
            return held is not None
        value = self.value
        if self.fold:
            held, value = held.lower(), value.lower()
        if self.op == "=":
            return held == value
        if self.op == "~=":
            return value in held.split()
        if not value:
            return False
        return value in held if self.op == "*=" else held.startswith(value) if self.op == "^=" else held.endswith(value)


@dataclass(frozen=True)
class Step:
    """An element by tag, id, classes and attributes, and how it stands to the step before it.

    ``link`` is ``""`` for the first step, else a blank (inside), ``>`` (child), ``+`` (next sibling) or
    ``~`` (later sibling).
    """

    link: str
    tag: str | None
    tests: tuple[Test, ...]

    def holds(self, tag: str, attrs: Mapping[str, str]) -> bool:
        return (self.tag is None or self.tag == tag) and all(t.holds(attrs) for t in self.tests)


def _alternatives(selector: str) -> list[str]:
    """Split at commas outside of brackets."""
    return [part.strip() for part in re.split(r",(?![^\[]*\])", selector) if part.strip()]


def _path(text: str) -> tuple[Step, ...]:
    steps: list[Step] = []
    link, tag, tests, at, begun = "", None, [], 0, False

    def close() -> None:
        nonlocal tag, tests, begun
        if not begun:
            raise ValueError(f"not a selector: {text!r}")
        steps.append(Step(link, tag, tuple(tests)))
        tag, tests, begun = None, [], False

    while at < len(text):
        found = _STEP.match(text, at)
        if not found:
            raise ValueError(f"not a selector: {text!r}")
        at = found.end()
        sign, name, by_id, by_class, by_test = found.groups()
        if sign is not None:
            close()
            link = sign if sign in ">+~" else " "
            continue
        begun = True
        if name is not None:
            tag = None if name == "*" else name.lower()
        elif by_id is not None:
            tests.append(Test("id", "=", by_id))
        elif by_class is not None:
            tests.append(Test("class", "~=", by_class))
        else:
            test = _TEST.match(by_test)
            if not test:
                raise ValueError(f"not a selector: {text!r}")
            key, op, *values, fold = test.groups()
            tests.append(Test(key.lower(), op or "", next((v for v in values if v is not None), ""), bool(fold)))
    close()
    return tuple(steps)


@lru_cache(maxsize=4096)
def compiled(selector: str) -> tuple[tuple[Step, ...], ...]:
    """Paths of a selector, one per alternative between commas."""
    paths = tuple(_path(part) for part in _alternatives(selector))
    if not paths:
        raise ValueError(f"not a selector: {selector!r}")
    return paths


class Elements:
    """The elements of one parsed page, found by selectors. ``nodes`` are in document order."""

    def __init__(self, nodes: Sequence[Mapping]):
        self.tags = [n["tag"] for n in nodes]
        self.attrs = [dict(n["attrs"]) for n in nodes]
        self.parents = [n["parent"] for n in nodes]
        self.lasts = [n["last"] for n in nodes]
        self._found: dict[str, list[int]] = {}
        self._by_tag: dict[str, list[int]] = {}
        self._before: list[int] | None = None
        for number, tag in enumerate(self.tags):
            self._by_tag.setdefault(tag, []).append(number)

    def select(self, selector: str) -> list[int]:
        """Numbers of all elements that a selector names, in document order, each once."""
        found = self._found.get(selector)
        if found is None:
            hits = {n for path in compiled(selector) for n in self._of_path(path)}
            found = self._found[selector] = sorted(hits)
        return found

    def first(self, selector: str) -> int | None:
        found = self.select(selector)
        return found[0] if found else None

    def inside(self, node: int, outer: int) -> bool:
        return outer < node <= self.lasts[outer]

    def _of_path(self, path: tuple[Step, ...]) -> list[int]:
        last = path[-1]
        pool = self._by_tag.get(last.tag, []) if last.tag else range(len(self.tags))
        return [n for n in pool if last.holds(self.tags[n], self.attrs[n]) and self._leads(path, len(path) - 1, n)]

    def _leads(self, path: tuple[Step, ...], at: int, node: int) -> bool:
        """Whether the steps before ``at`` hold for an element that stands at step ``at``."""
        if at == 0:
            return True
        for other in self._related(path[at].link, node):
            if path[at - 1].holds(self.tags[other], self.attrs[other]) and self._leads(path, at - 1, other):
                return True
        return False

    def _related(self, link: str, node: int):
        if link in " >":
            node = self.parents[node]
            while node >= 0:
                yield node
                if link == ">":
                    return
                node = self.parents[node]
            return
        if self._before is None:
            self._before, latest = [-1] * len(self.tags), {}
            for number, parent in enumerate(self.parents):
                self._before[number] = latest.get(parent, -1)
                latest[parent] = number
        node = self._before[node]
        while node >= 0:
            yield node
            if link == "+":
                return
            node = self._before[node]


def reader(selector: str) -> Callable[[Elements], list[int]]:
    """A selector as a function; a wrong one is refused at once, not in a task."""
    compiled(selector)
    return lambda elements: elements.select(selector)
