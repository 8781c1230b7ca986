"""Plain LRU list, the rule the distributed operators are held against."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Access:
    key: int
    t: int | None
    objects: int
    size: int


@dataclass
class LruList:
    """Distances over one shard, requests given in order."""

    start: int | None = None
    stack: list[str] = field(default_factory=list)
    sizes: dict[str, int] = field(default_factory=dict)
    last: dict[str, float] = field(default_factory=dict)

    def run(self, requests) -> list[Access]:
        found = []
        for key, ts, obj, size in requests:
            if size <= 0:
                continue
            if obj in self.sizes:
                above = self.stack[self.stack.index(obj) + 1:]
                count, amount = len(above), sum(self.sizes[o] for o in above)
                if count:
                    count, amount = count + 1, amount + self.sizes[obj]
                counted = self.start is None or int(ts) >= self.start
                found.append(Access(key, int(ts - self.last[obj]) if counted else None,
                                    count, amount))
                self.stack.remove(obj)
            else:
                self.sizes[obj] = size
            self.stack.append(obj)
            self.last[obj] = ts
        return found


def digest(name: str) -> str:
    import hashlib

    return hashlib.md5(name.encode()).hexdigest()[:16].upper()


def thin(rows, jump):
    """Rows (t, std_mib, std_objects, requests, bytes, tb, tr) kept by the scan."""
    kept, held, printed = [], [0, 0, 0, 0], None
    for row in rows:
        held = [h + x for h, x in zip(held, row[3:])]
        if printed is None:
            show = 100.0 >= jump
        else:
            pt, ps = printed
            dt = float("inf") if pt == 0 else abs((row[0] - pt) * 100.0 / pt)
            if ps == 0:
                ds = float("inf") if row[1] else float("nan")
            else:
                ds = abs((row[1] - ps) * 100.0 / ps)
            show = dt > jump or ds >= jump
        if show:
            kept.append((*row[:3], *held))
            printed, held = (row[0], row[1]), [0, 0, 0, 0]
    if held[0] > 0:
        kept.append((*rows[-1][:3], *held))
    return kept
