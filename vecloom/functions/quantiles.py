"""Mergeable quantile sketch of sort keys."""

from __future__ import annotations

import random
import sys
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys of one weight that a sketch holds; the error of a rank is about 1/HELD of all rows.
HELD = 4096


def _order(key: tuple) -> tuple:
    """Nulls first, as Spark sorts."""
    return tuple((v is not None, v) if v is not None else (False,) for v in key)


@dataclass
class KeySketch:
    """Keys by weight: each of ``levels[i]`` stands for 2**i rows of the ``n`` seen.

    A level that holds too many keys is sorted and every second one goes to the next level;
    which of the two is drawn, so that errors cancel out.
    """

    levels: list[list[tuple]]
    n: int

    def compacted(self) -> KeySketch:
        draw = random.Random(self.n)
        for i in range(64):
            if i >= len(self.levels):
                break
            if len(self.levels[i]) > HELD:
                level = sorted(self.levels[i], key=_order)
                rest = level[len(level) - len(level) % 2 :]
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1] = self.levels[i + 1] + level[draw.randrange(2) : len(level) - len(level) % 2 : 2]
                self.levels[i] = rest
        return self

    def merged(self, other: KeySketch) -> KeySketch:
        depth = max(len(self.levels), len(other.levels))
        a, b = (s.levels + [[]] * (depth - len(s.levels)) for s in (self, other))
        return KeySketch([x + y for x, y in zip(a, b, strict=True)], self.n + other.n).compacted()

    def bounds(self, parts: int) -> list[tuple[Any, ...]]:
        """Distinct keys that begin the second and further of ``parts`` ranges of about equal size."""
        weighted = sorted(((k, 1 << i) for i, level in enumerate(self.levels) for k in level), key=lambda x: _order(x[0]))
        out: list[tuple] = []
        total, seen = sum(w for _, w in weighted), 0
        for key, weight in weighted:
            if seen >= total * (len(out) + 1) / parts and len(out) < parts - 1 and (not out or key != out[-1]):
                out.append(key)
            seen += weight
        return out
