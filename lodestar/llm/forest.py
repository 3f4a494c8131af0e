"""Union-find over the links a task meets, so that it reports a forest and not every link."""

from __future__ import annotations


class Forest:
    """``add`` says whether a link joined two trees; only such links need to leave the task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def add(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
