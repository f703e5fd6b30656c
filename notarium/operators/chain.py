"""Named text transforms, chains of them, and a dry-run plan of what a chain would change."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from ..functions import documents as fn


@dataclass(frozen=True)
class Transform:
    """A text transform: its tier is safe or review; only safe ones may be written."""

    name: str
    run: Callable[[str], str]
    tier: str = "safe"


REGISTRY: dict[str, Transform] = {}


def register(t: Transform) -> Transform:
    if t.name in REGISTRY:
        raise ValueError(f"transform {t.name} is registered already")
    REGISTRY[t.name] = t
    return t


register(Transform("normalize", fn.normal_body))
register(Transform("repair", lambda text: fn.repair(text)[0]))
register(Transform("links", fn.spaced_links))
register(Transform("fence_indented", fn.fence_indented, "review"))


def writable(names: list[str]) -> bool:
    """Whether every transform of a chain is safe."""
    return all(REGISTRY[n].tier == "safe" for n in names)


def apply(text: str, names: list[str]) -> str:
    """The chain from left to right."""
    return reduce(lambda x, n: REGISTRY[n].run(x), names, text)


def plan(df: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """(id, changed, tier, added, removed, stable): what the chain would do; nothing is written.

    ``stable`` says that a second run changes nothing, which a write must wait for.
    """
    steps = [REGISTRY[n].run for n in names]

    def one(text: str):
        new = text
        for run in steps:
            new = run(new)
        again = new
        for run in steps:
            again = run(again)
        added, removed = fn.changed_lines(text, new) if new != text else (0, 0)
        return [(new != text, fn.tier(text, new), added, removed, again == new)]

    return fn.map_texts(df, id_col, text_col, one, "changed boolean, tier string, added int, removed int, stable boolean")
