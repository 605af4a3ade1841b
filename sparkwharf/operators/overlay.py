"""The union of a few polygons within a task, many groups of them at once in arrays: the first rounds of :func:`planar.union_layer`.

A polygon is a list of directed segments in whole grid steps, its area to their left. As in :mod:`planar`, segments run through all ends and rounded
crossings whose unit square they touch, and a side of a segment is inside if the winding number of some polygon is over 0 there.
Pairs are formed of segments of one group that overlap in x only, by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Segments of a group, unless ``FEW`` polygons have more; of a polygon, over which it is left as it is; of the groups that are worked on at once.
GROUP, FEW, LARGE, TOGETHER = 48, 4, 1024, 1 << 13
WAY, ROW = ("px", "py", "qx", "qy"), ("k", "done", "size", "strip", "y", "x", "ways")
_SPAN = np.int64(1) << 32


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``i, j`` with ``low[i] <= j < high[i]``."""
    n = np.maximum(high - low, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n - low, n)


def _turn(ox, oy, px, py, qx, qy):
    return (px - ox) * (qy - oy) - (py - oy) * (qx - ox)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by their columns, and the number of each ordered row among distinct ones."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order, np.cumsum(new)


def _rounded(v: np.ndarray) -> np.ndarray:
    return np.floor(v + 0.5).astype(np.int64)


def united(g: np.ndarray, p: np.ndarray, ways: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups and ``px, py, qx, qy`` of the outlines; ``g`` ascending, ``p`` the number of the polygon in its group, ``ways`` as the result."""
    px, py, qx, qy = ways.T
    ahead = (px < qx) | ((px == qx) & (py < qy))
    ax, ay, bx, by = (np.where(ahead, s, t) for s, t in ((px, qx), (py, qy), (qx, px), (qy, py)))
    w = np.where(ahead, 1, -1)
    least = ax.min()
    at = lambda group, x: group * _SPAN + (x - least)
    order = np.lexsort((by, bx, ay, ax, g))
    g, p, w, ax, ay, bx, by = (c[order] for c in (g, p, w, ax, ay, bx, by))

    i, j = _ranges(np.arange(1, len(g) + 1), np.searchsorted(at(g, ax), at(g, bx), side="right"))
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    near = (low[i] <= high[j]) & (low[j] <= high[i])
    i, j = i[near], j[near]
    a, b, c, d = (ax[i], ay[i]), (bx[i], by[i]), (ax[j], ay[j]), (bx[j], by[j])
    apart = (np.sign(_turn(*a, *b, *c)) * np.sign(_turn(*a, *b, *d)) < 0) & (np.sign(_turn(*c, *d, *a)) * np.sign(_turn(*c, *d, *b)) < 0)
    i, j = i[apart], j[apart]
    cda, cdb = (_turn(ax[j], ay[j], bx[j], by[j], x[i], y[i]).astype(float) for x, y in ((ax, ay), (bx, by)))
    share = cda / (cda - cdb)
    x = np.concatenate([ax, bx, _rounded(ax[i] + (bx[i] - ax[i]) * share)])
    y = np.concatenate([ay, by, _rounded(ay[i] + (by[i] - ay[i]) * share)])
    of = np.concatenate([g, g, g[i]])
    order, number = _distinct(of, x, y)
    first = order[np.flatnonzero(np.diff(number, prepend=-1))]
    of, x, y = of[first], x[first], y[first]

    places = at(of, x)
    s, t = _ranges(np.searchsorted(places, at(g, ax)), np.searchsorted(places, at(g, bx), side="right"))
    within = (y[t] >= low[s]) & (y[t] <= high[s])
    s, t = s[within], t[within]
    dx, dy, ex, ey = bx[s] - ax[s], by[s] - ay[s], x[t] - ax[s], y[t] - ay[s]
    touched = 2 * np.abs(dx * ey - dy * ex) <= dx + np.abs(dy)
    s, t, along = s[touched], t[touched], (ex * dx + ey * dy)[touched]
    order = np.lexsort((y[t], x[t], along, s))
    s, t = s[order], t[order]
    on = np.flatnonzero(s[1:] == s[:-1])
    s, u, v = s[on], t[on], t[on + 1]
    ahead = u < v  # points are in order of x, then y
    g, p, w, u, v = g[s], p[s], np.where(ahead, w[s], -w[s]), np.minimum(u, v), np.maximum(u, v)
    ax, ay, bx, by = x[u], y[u], x[v], y[v]

    order, number = _distinct(u, v)  # a point belongs to one group
    first = order[np.flatnonzero(np.diff(number, prepend=-1))]
    most = int(p.max()) + 1
    cell = np.empty(len(g), np.int64)
    cell[order] = number
    across = np.bincount(cell * most + p, w, len(first) * most).reshape(-1, most)
    mx, my = ax[first] + bx[first], ay[first] + by[first]
    # ``first`` is in order of u, so of group and x; all segments in that order
    c = order
    starts, longest = at(g[c], ax[c]), int((bx - ax).max())
    m, o = _ranges(np.searchsorted(starts, at(g[first], mx // 2 - longest)), np.searchsorted(starts, at(g[first], mx // 2), side="right"))
    o = c[o]
    below = (g[o] == g[first][m]) & (2 * ax[o] <= mx[m]) & (mx[m] < 2 * bx[o])
    m, o = m[below], o[below]
    below = _turn(2 * ax[o], 2 * ay[o], 2 * bx[o], 2 * by[o], mx[m], my[m]) > 0
    m, o = m[below], o[below]
    right = np.bincount(m * most + p[o], w[o], len(first) * most).reshape(-1, most)
    inside, beyond = (right > 0).any(1), (right + across > 0).any(1)
    kept = np.flatnonzero(inside != beyond)
    ends, ahead = np.stack([ax, ay, bx, by], 1)[first[kept]], beyond[kept]
    return g[first[kept]], np.where(ahead[:, None], ends, ends[:, [2, 3, 0, 1]])


def _placed(k: pa.Array, done: np.ndarray, sizes: np.ndarray, ways: np.ndarray) -> pa.RecordBatch:
    """Rows of ``ROW``: polygons of ``sizes`` segments, none empty, with their class of size, a strip as wide as that, and where they are in it."""
    ends = np.cumsum(sizes)
    first = ends - sizes
    x, y = (np.minimum.reduceat(ways[:, c], first) for c in (0, 1))
    extent = np.maximum(np.maximum.reduceat(ways[:, 0], first) - x, np.maximum.reduceat(ways[:, 1], first) - y)
    size = np.ceil(np.log2(np.maximum(extent, 16))).astype(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in ways.T], list(WAY)))
    return pa.RecordBatch.from_arrays([k, pa.array(done), pa.array(size), pa.array(x >> size), pa.array(y), pa.array(x), lists], list(ROW))


def way_batches(batches: Iterator[pa.RecordBatch], unit: float) -> Iterator[pa.RecordBatch]:
    """Batches ``k, rings`` without nulls to rows of ``ROW``; rings with a null, without area or of less than three points are ignored."""
    for batch in batches:
        k, polygons = batch.column("k"), batch.column("rings")
        rings = polygons.flatten()
        n_rings, n = (pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (polygons, rings))
        points, of = rings.flatten(), np.repeat(np.arange(len(k)), n_rings)
        shell = np.arange(len(rings)) == np.repeat(np.cumsum(n_rings) - n_rings, n_rings)
        x, y = (pc.struct_field(points, c).cast(pa.float64()).to_numpy(zero_copy_only=False) / unit for c in ("lng", "lat"))
        ring, ends = np.repeat(np.arange(len(n)), n), np.cumsum(n)
        bad = np.bincount(ring, ~(np.isfinite(x) & np.isfinite(y)), len(n)) > 0
        x, y = (np.where(np.isfinite(c), np.trunc(c) + np.sign(c) * (np.abs(c - np.trunc(c)) >= 0.5), 0).astype(np.int64) for c in (x, y))
        follow = np.arange(1, len(x) + 1)
        follow[ends[n > 0] - 1] = (ends - n)[n > 0]
        qx, qy, ox, oy = x[follow], y[follow], x[(ends - n)[ring]], y[(ends - n)[ring]]
        area = np.zeros(len(n), np.int64)
        np.add.at(area, ring, (x - ox) * (qy - oy) - (qx - ox) * (y - oy))
        kept = ((n > 2) & (area != 0) & ~bad)[ring] & ((x != qx) | (y != qy))
        ways = np.stack([x, y, qx, qy], 1)
        ways = np.where(((area > 0) == shell)[ring][:, None], ways, ways[:, [2, 3, 0, 1]])[kept]
        sizes = np.bincount(of[ring][kept], minlength=len(k))
        if len(ways):
            yield _placed(k.filter(pa.array(sizes > 0)), np.zeros((sizes > 0).sum(), bool), sizes[sizes > 0], ways)


def groups(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The group of each polygon: neighbours of one key, of ``GROUP`` segments together or ``FEW`` of them; a large one is alone."""
    out, group, held, n = [], -1, 0, 0  # and what the last polygon had
    for i, (key, size) in enumerate(zip(keys.tolist(), sizes.tolist(), strict=True)):
        if i == 0 or key != last or size > LARGE or was > LARGE or (n >= FEW and held + size > GROUP):
            group, held, n = group + 1, 0, 0
        held, n, last, was = held + size, n + 1, key, size
        out.append(group)
    return np.array(out, np.int64)


def united_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches ``k, ways`` sorted by key, to rows of ``ROW``, one for each group that has an outline."""
    for batch in batches:
        if not batch.num_rows:
            continue
        k, lists = batch.column("k"), batch.column("ways")
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = lists.flatten()
        ways = np.stack([flat.field(c).to_numpy() for c in WAY], 1)
        number = k.dictionary_encode().indices.to_numpy()
        group = groups(number, sizes)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        once = (np.bincount(number[first]) == 1)[number] & (number != number[0]) & (number != number[-1])  # others may go on in another batch
        before = np.append(0, np.cumsum(sizes))
        of, p = np.repeat(group, sizes), np.repeat(np.arange(len(group)) - first[group], sizes)
        starts = np.append(before[first], before[-1])
        alone = np.diff(starts) > 0
        alone &= sizes[first] > LARGE
        made, made_of, a = [], [], 0
        while a < len(first):
            if alone[a]:
                b = a + 1
                made.append(ways[starts[a] : starts[b]])
                made_of.append(of[starts[a] : starts[b]])
            else:
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + TOGETHER, side="right")) - 1)
                b = min([b, *(a + np.flatnonzero(alone[a:b])[:1])])
                if starts[b] > starts[a]:
                    some, found = united(of[starts[a] : starts[b]], p[starts[a] : starts[b]], ways[starts[a] : starts[b]])
                    order = np.argsort(some, kind="stable")
                    made.append(found[order])
                    made_of.append(some[order])
            a = b
        if made and sum(map(len, made)):
            made, made_of = np.concatenate(made), np.concatenate(made_of)
            at = np.flatnonzero(np.diff(made_of, prepend=-1))
            yield _placed(k.take(pa.array(first[made_of[at]])), once[first[made_of[at]]], np.diff(np.append(at, len(made))), made)
