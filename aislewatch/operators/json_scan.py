"""A scanner of JSON texts that keeps only what is asked for.

It reads a text token by token with a stack of its own, so depth has no limit, builds no values, and returns what
it finds as places in the text. Its cost grows with the text, however objects nest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

#: One token after white space: a string, a sign, or a number or word. A string's escapes are checked.
_TOKEN = re.compile(
    r'[ \t\n\r]*(?:("[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*")|([{}\[\],:])'
    r"|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.+-])|true|false|null|NaN|-?Infinity))"
)
_REST = re.compile(r"[ \t\n\r]*")
_TRAILING = re.compile(r"\s*,\s*$")

# What may come next.
_VALUE, _FIRST_VALUE, _KEY, _FIRST_KEY, _COLON, _AFTER, _END = range(7)


def _string(token: str) -> str:
    return json.loads(token) if "\\" in token else token[1:-1]


class _Frame:
    """An open object or list: its number in document order, where it starts, and what it holds so far."""

    __slots__ = ("number", "start", "is_object", "key", "types", "held", "flags", "parent_key")

    def __init__(self, number: int, start: int, is_object: bool, parent_key: str | None):
        self.number, self.start, self.is_object, self.parent_key = number, start, is_object, parent_key
        self.key: str | None = None
        self.types: list[str] | None = None
        self.held: dict[str, tuple[int, int, str]] | None = None
        self.flags: dict[str, tuple[int, str]] | None = None


def scan(text: str, searches: Mapping[str, Sequence[str]], flags: Mapping[str, tuple[Sequence[str], str]]) -> dict | None:
    """``products`` (spans), ``found`` and ``flags`` (texts) of a JSON text; None if it is no JSON.

    Objects come in document order. Of a repeated key the last value counts. ``found``: per search the value of its
    first listed key that is not null in the first object that holds any. ``flags``: per flag the last value of its type.
    """
    wanted = {k for keys in searches.values() for k in keys}
    flag_of = {key: (name, kind) for name, (keys, kind) in flags.items() for key in keys}
    products: list[tuple[int, int, int]] = []
    holders: list[tuple[int, dict[str, tuple[int, int, str]]]] = []
    raised: dict[str, tuple[int, int, str]] = {}
    stack: list[_Frame] = []
    number, at, state, match = 0, 0, _VALUE, _TOKEN.match

    def keep(frame: _Frame, start: int, end: int, kind: str) -> None:
        """Note a finished value of an object if its key is asked for."""
        key = frame.key
        if key == "@type" and kind == "string":
            frame.types = [_string(text[start:end])]
        elif key == "@type" and kind != "list":
            frame.types = None
        if key in wanted:
            if frame.held is None:
                frame.held = {}
            frame.held[key] = (start, end, kind)
        if flag_of:
            flag = flag_of.get(key.lower())
            if flag and (kind == "string" if flag[1] == "STRING" else kind == "boolean"):
                value = _string(text[start:end]) if kind == "string" else text[start:end]
                raised_by = raised.get(flag[0])
                if raised_by is None or (frame.number, start) > raised_by[:2]:
                    raised[flag[0]] = (frame.number, start, value)

    while True:
        token = match(text, at)
        if token is None:
            break
        at = token.end()
        kind = token.lastindex
        start = token.start(kind)
        if kind == 2:
            sign = text[start]
            if sign in "{[":
                if state not in (_VALUE, _FIRST_VALUE):
                    return None
                parent = stack[-1] if stack else None
                stack.append(_Frame(number, start, sign == "{", parent.key if parent and parent.is_object else None))
                number += 1
                state = _FIRST_KEY if sign == "{" else _FIRST_VALUE
                continue
            if sign in "}]":
                frame = stack[-1] if stack else None
                empty = _FIRST_KEY if sign == "}" else _FIRST_VALUE
                if frame is None or frame.is_object != (sign == "}") or state not in (_AFTER, empty):
                    return None
                stack.pop()
                if frame.is_object:
                    if frame.types and "Product" in frame.types:
                        products.append((frame.number, frame.start, at))
                    if frame.held:
                        holders.append((frame.number, frame.held))
                parent = stack[-1] if stack else None
                if parent is not None and parent.is_object:
                    keep(parent, frame.start, at, "object" if frame.is_object else "list")
                    if frame.parent_key == "@type" and not frame.is_object:
                        parent.types = frame.types or []
                state = _AFTER if stack else _END
                continue
            if sign == ":":
                if state != _COLON:
                    return None
                state = _VALUE
                continue
            if state != _AFTER or not stack:
                return None
            state = _KEY if stack[-1].is_object else _VALUE
            continue
        if kind == 1 and state in (_KEY, _FIRST_KEY):
            stack[-1].key = _string(text[start:at])
            state = _COLON
            continue
        if state not in (_VALUE, _FIRST_VALUE):
            return None
        frame = stack[-1] if stack else None
        if frame is not None and frame.is_object:
            word = text[start:at]
            keep(frame, start, at, "string" if kind == 1 else "boolean" if word in ("true", "false") else "null" if word == "null" else "number")
        elif frame is not None and frame.parent_key == "@type" and kind == 1:
            # The types of a list belong to the object around it.
            frame.types = [*(frame.types or []), _string(text[start:at])]
        state = _AFTER if stack else _END
    if state != _END or _REST.match(text, at).end() != len(text):
        return None
    products.sort()
    found: dict[str, str] = {}
    if searches:
        holders.sort(key=lambda h: h[0])
        for name, keys in searches.items():
            for _, held in holders:
                value = next((held[k] for k in keys if k in held and held[k][2] != "null"), None)
                if value is not None:
                    start, end, kind = value
                    found[name] = _string(text[start:end]) if kind == "string" else text[start:end]
                    break
    return {
        "products": [(start, end - start) for _, start, end in products],
        "found": found,
        "flags": {name: value for name, (_, _, value) in raised.items()},
    }


def scanned(text: str | None, searches: Mapping[str, Sequence[str]], flags: Mapping[str, tuple[Sequence[str], str]]) -> dict:
    """``scan`` of a text as pages hold it: blanks around it and one trailing comma are left out.

    A text that is not there or no JSON holds nothing, and neither does one that names no key asked for.
    """
    nothing = {"products": [], "found": {}, "flags": {}}
    if not text:
        return nothing
    lower = text.lower()
    marks = ['"product"', *(k.lower() for keys in searches.values() for k in keys), *(k for keys, _ in flags.values() for k in keys)]
    if "\\u" not in lower and not any(mark in lower for mark in marks):
        return nothing
    lead = len(text) - len(text.lstrip())
    found = scan(_TRAILING.sub("", text[lead:].rstrip()), searches, flags) or nothing
    # Places count from 1 in the text as it was given.
    return found | {"products": [(start + lead + 1, size) for start, size in found["products"]]}
