"""Fenced code in note texts."""

from __future__ import annotations

import re

_FENCE_LINE = re.compile(r"^[^\S\n]*(`{3,}|~{3,})([^\n]*)$", re.M)


def fences(text: str) -> list[tuple[int, int]]:
    """(begin, end) of each fenced block, fence lines included.

    A fence opens at a line that begins with three or more backticks or tildes
    and closes at a line of nothing but three or more of the same character, or
    at the end of the text.
    """
    if "```" not in text and "~~~" not in text:
        return []
    out, begin, mark = [], -1, ""
    for m in _FENCE_LINE.finditer(text):
        run = m[1][0]
        if begin < 0:
            begin, mark = m.start(), run
        elif run == mark and not m[2].strip():
            out.append((begin, m.end()))
            begin = -1
    if begin >= 0:
        out.append((begin, len(text)))
    return out


def without_fences(text: str, by: str = "\n\n") -> str:
    """The text with each fenced block replaced."""
    spans = fences(text)
    if not spans:
        return text
    parts, at = [], 0
    for b, e in spans:
        parts += [text[at:b], by]
        at = e
    return "".join([*parts, text[at:]])
