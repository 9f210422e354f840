"""Minimum cuts of small graphs with two terminals.

`pull[v]` is the capacity between v and the source (positive) or the sink (negative); edges have the same capacity both ways.
A node whose pull outweighs all its edges lies on that side of every minimum cut: it is decided at once, and its edges become
pull of its neighbours. What is left goes through blocking flows on the residual graph. Of equal cuts, the one
with the smallest source side is returned.
"""

from __future__ import annotations

from collections import deque


def source_side(pull: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """For each node, whether it lies on the source's side."""
    n = len(pull)
    pull = list(pull)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    weight = [0] * n
    for u, v, c in edges:
        if u != v and c > 0:
            near[u].append((v, c))
            near[v].append((u, c))
            weight[u] += c
            weight[v] += c
    side: list[bool | None] = [None] * n
    ready = [v for v in range(n) if abs(pull[v]) > weight[v]]
    while ready:
        u = ready.pop()
        if side[u] is not None:
            continue
        side[u] = pull[u] > 0
        for v, c in near[u]:
            if side[v] is None:
                pull[v] += c if side[u] else -c
                weight[v] -= c
                if abs(pull[v]) > weight[v]:
                    ready.append(v)
    left = [v for v in range(n) if side[v] is None]
    if left:
        number = {v: k for k, v in enumerate(left)}
        between = [
            (k, number[v], c) for k, u in enumerate(left) for v, c in near[u] if side[v] is None and u < v
        ]
        for v, on_source in zip(left, _by_flow([pull[v] for v in left], between), strict=True):
            side[v] = on_source
    return [bool(s) for s in side]


def _by_flow(pull: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    n = len(pull)
    source, sink = n, n + 1
    ends: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(u: int, v: int, there: int, back: int) -> None:
        out[u].append(len(ends))
        ends.append(v)
        room.append(there)
        out[v].append(len(ends))
        ends.append(u)
        room.append(back)

    for v, p in enumerate(pull):
        if p > 0:
            join(source, v, p, 0)
        elif p < 0:
            join(v, sink, -p, 0)
    for u, v, c in edges:
        join(u, v, c, c)

    def levels() -> list[int]:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                v = ends[e]
                if room[e] > 0 and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        return level

    while (level := levels())[sink] >= 0:
        tried = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # go on from the first edge that is full now
                first = next(k for k, e in enumerate(path) if not room[e])
                u = ends[path[first] ^ 1]
                del path[first:]
                continue
            while tried[u] < len(out[u]):
                e = out[u][tried[u]]
                if room[e] > 0 and level[ends[e]] == level[u] + 1:
                    break
                tried[u] += 1
            if tried[u] < len(out[u]):
                path.append(e)
                u = ends[e]
            elif path:
                u = ends[path.pop() ^ 1]
                tried[u] += 1
            else:
                break
    return [level[v] >= 0 for v in range(n)]
