"""The columns of a landed batch, and how they differ from those of the batch before."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Drift:
    """What changed from one header to the next. ``retyped`` has the type before and after of each column."""

    added: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()
    reordered: tuple[str, ...] = ()
    retyped: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.gone or self.reordered or self.retyped)

    def __str__(self) -> str:
        parts = [f"{name}: {', '.join(found)}" for name in ("added", "gone", "reordered") if (found := getattr(self, name))]
        if self.retyped:
            parts.append("retyped: " + ", ".join(f"{n} from {a} to {b}" for n, (a, b) in self.retyped.items()))
        return "; ".join(parts) or "none"


@dataclass(frozen=True)
class Header:
    """Names and types of columns, in order. Names are told apart to the letter."""

    columns: tuple[tuple[str, str], ...]

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.columns, ensure_ascii=False).encode()).hexdigest()

    def to_json(self) -> str:
        return json.dumps({"digest": self.digest, "columns": self.columns}, ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> Header:
        return Header(tuple((name, kind) for name, kind in json.loads(text)["columns"]))

    def drift_from(self, before: Header) -> Drift:
        """What is new in this header. Reordered are columns that stand before one that stood before them."""
        if self.digest == before.digest:
            return Drift()
        old, new = dict(before.columns), dict(self.columns)
        place = {name: k for k, (name, _) in enumerate(before.columns)}
        common = [name for name, _ in self.columns if name in old]
        least, moved = len(place), set()
        for name in reversed(common):
            if place[name] > least:
                moved.add(name)
            least = min(least, place[name])
        return Drift(
            added=tuple(name for name, _ in self.columns if name not in old),
            gone=tuple(name for name, _ in before.columns if name not in new),
            reordered=tuple(name for name in common if name in moved),
            retyped={name: (old[name], new[name]) for name in common if old[name] != new[name]},
        )
