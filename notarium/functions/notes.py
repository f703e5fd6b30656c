"""Changes of single notes: additive front matter, review patches."""

from __future__ import annotations

import re


def add_list(text: str, key: str, values: list[str]) -> str:
    """The note with ``key`` as a list at the end of its front matter; a note without front matter, or with the key, stays."""
    m = re.match(r"---\n(.*?)^---[ \t]*\n", text, re.S | re.M)
    if not m or not values or re.search(rf"^{re.escape(key)}:", m[1], re.M):
        return text
    at = m.start(1) + len(m[1])
    quoted = ["'" + v.replace("'", "''") + "'" for v in values]
    return text[:at] + f"{key}:\n" + "".join(f"  - {v}\n" for v in quoted) + text[at:]


def without_list(text: str, key: str) -> str:
    """The note without the list that ``add_list`` put in."""
    return re.sub(rf"^{re.escape(key)}:\n(?:  - '(?:[^'\n]|'')*'\n)+", "", text, count=1, flags=re.M)


def is_additive(before: str, after: str, key: str) -> bool:
    """Whether taking the list out again gives the same bytes."""
    return after == before or without_list(after, key) == before


def without_tokens(text: str) -> tuple[str, int]:
    """The note without leaked search tokens, and how many there were."""
    return re.subn(r"[ \t]?turn\d+(?:view|search)\d+", "", text)


def rebuilt_links(text: str) -> tuple[str, int]:
    """Labels mashed with addresses as links: ``urlLabelhttps://x`` and ``<Label>https://x``."""
    text, a = re.subn(r"\burl([^\s<>\[\]()]+?)(https?://[^\s)\]]+)", r"[\1](\2)", text)
    text, c = re.subn(r"<(?!https?:)([^<>\n]+)>(https?://[^\s)\]]+)", r"[\1](\2)", text)
    return text, a + c
