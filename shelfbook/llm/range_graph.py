"""A robust-pruned flat graph over unit vectors, and range-expanding greedy search in it.

Vectors very close to an earlier one hang on it as on their leader, so that tight groups, whose members would fill each
other's short lists, are one node each. A leader's radius is the widest angle to its members. Of a leader's nearest leaders, a
few of those that may hold partners, and a few at random, robust pruning keeps those that no kept one dominates.

A search for one leader descends greedily from the medoids, and then expands from where it ends, and from the leader itself,
through all leaders that may hold a partner, with some slack. What it reaches are candidates; the caller confirms them.
"""

from __future__ import annotations

import numpy as np

CLOSE = 0.985  # cosine from which on a vector hangs on a leader
DEGREE, CANDIDATES, IN_RANGE, ANYWHERE = 16, 32, 24, 8
ALPHA = 1.2
MEDOIDS, STEPS = 8, 32
SLACK = 0.1  # angle beyond the range that is still walked through
ROUNDING = 0.002  # angle that products in single precision may be off
BLOCK = 512


def leaders(x: np.ndarray, close: float = CLOSE) -> np.ndarray:
    """The row that each row hangs on: the first leader close enough in its block, else the closest of those before."""
    n = len(x)
    lead = np.full(n, -1)
    known = np.zeros(0, int)
    for low in range(0, n, BLOCK):
        own = np.arange(low, min(n, low + BLOCK))
        if len(known):
            sims = x[own] @ x[known].T
            best = sims.argmax(axis=1)
            near = sims[np.arange(len(own)), best] >= close
            lead[own[near]] = known[best[near]]
        inner = x[own] @ x[own].T >= close
        fresh = []
        for k, row in enumerate(own):
            if lead[row] < 0:
                fresh.append(row)
                open_ = inner[k] & (lead[own] < 0)
                lead[own[open_]] = row
                lead[row] = row
        known = np.concatenate([known, np.array(fresh, int)])
    return lead


def radii(x: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """For each row, the widest angle to the rows that hang on it."""
    angle = np.arccos(np.clip(np.einsum("nd,nd->n", x, x[lead]), -1, 1))
    angle[lead == np.arange(len(x))] = 0
    out = np.zeros(len(x))
    np.maximum.at(out, lead, angle)
    return out


def pruned(x: np.ndarray, radius: np.ndarray, threshold: float, seed: int = 5) -> np.ndarray:
    """Neighbours (rows by DEGREE, -1 for none) of every row by robust pruning of its candidates."""
    n = len(x)
    out = np.full((n, DEGREE), -1, np.int64)
    if n < 2:
        return out
    x = x.astype(np.float32)
    pick = np.random.default_rng(seed)
    limit = np.cos(np.minimum(np.arccos(threshold) + radius + radius.max(), np.pi)).astype(np.float32)
    width, spread = min(CANDIDATES, n - 1), min(IN_RANGE, n - 1)
    for low in range(0, n, BLOCK):
        own = np.arange(low, min(n, low + BLOCK))
        at = np.arange(len(own))
        sims = x[own] @ x.T
        sims[at, own] = -2
        cand = [np.argpartition(-sims, width - 1, axis=1)[:, :width], pick.integers(0, n, (len(own), ANYWHERE))]
        inside = sims >= limit[own][:, None]
        if (inside.sum(axis=1) > width).any():  # partners beyond the nearest ones: some of them, at random
            cand.append(np.argpartition(np.where(inside, pick.random(sims.shape, np.float32), 2), spread - 1, axis=1)[:, :spread])
        cand = np.concatenate(cand, axis=1)
        to_cand = np.take_along_axis(sims, cand, axis=1)
        order = np.argsort(-to_cand, axis=1, kind="stable")
        cand, to_cand = np.take_along_axis(cand, order, axis=1), np.take_along_axis(to_cand, order, axis=1)
        points = x[cand]
        between = np.maximum(2 - 2 * (points @ points.transpose(0, 2, 1)), 0)
        far = np.maximum(2 - 2 * to_cand, 0)
        alive = to_cand > -2  # not the node itself
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[at, first]
            if not some.any():
                break
            out[own[some], k] = cand[at, first][some]
            alive &= ALPHA * ALPHA * between[at, first] > far  # distances are squared
            alive[at, first] = False
    return out


def adjacency(x: np.ndarray, owner: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Padded neighbour lists (-1 for none) from edges, taken both ways.

    Of more than 4 * DEGREE neighbours a node keeps the nearest half of that number, and a scattered choice of the others.
    """
    n, most = len(x), 4 * DEGREE
    code = np.unique(np.concatenate([owner * n + to, to * n + owner]))
    owner, to = np.divmod(code[code // n != code % n], n)
    order = np.lexsort((-_cosines(x, owner, to), owner))
    owner, to = owner[order], to[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    scatter = (owner * 0x9E3779B1 + to * 0x85EBCA6B) & 0xFFFFFF
    order = np.lexsort((np.where(rank < most // 2, -1, scatter), owner))
    owner, to = owner[order], to[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    kept = rank < most
    out = np.full((n, min(most, int(rank.max()) + 1) if len(rank) else 1), -1)
    out[owner[kept], rank[kept]] = to[kept]
    return out


def _cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), x.dtype)
    for low in range(0, len(a), 1 << 15):
        part = slice(low, low + (1 << 15))
        out[part] = np.einsum("nd,nd->n", x[a[part]], x[b[part]])
    return out


def _descended(x: np.ndarray, lists: np.ndarray, queries: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The node at which each query's greedy walk from the best of ``start`` ends."""
    sims = x[queries] @ x[start].T
    at, value = start[sims.argmax(axis=1)], sims.max(axis=1)
    open_ = np.arange(len(queries))
    for _ in range(STEPS):
        near = lists[at[open_]]
        sims = np.einsum("qd,qkd->qk", x[queries[open_]], x[near])
        sims[near < 0] = -2
        best = sims.argmax(axis=1)
        sims = sims[np.arange(len(open_)), best]
        better = sims > value[open_]
        if not better.any():
            break
        at[open_[better]], value[open_[better]] = near[np.arange(len(open_)), best][better], sims[better]
        open_ = open_[better]
    return at


def reached(x: np.ndarray, radius: np.ndarray, lists: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows each row's search finds that may hold a partner of its members; a row always finds itself."""
    n = len(x)
    x = x.astype(np.float32)
    out = np.zeros((n, n), bool)
    centre = x.mean(axis=0)
    medoids = [int((x @ centre).argmax())]
    worst = x @ x[medoids[0]]
    while len(medoids) < min(MEDOIDS, n):  # one after the other, the node least like those before
        medoids.append(int(worst.argmin()))
        worst = np.maximum(worst, x @ x[medoids[-1]])
    medoids = np.array(medoids)
    link = np.arccos(threshold)
    for low in range(0, n, BLOCK):
        queries = np.arange(low, min(n, low + BLOCK))
        q = len(queries)
        seen, fresh = np.zeros(q * n, bool), np.zeros(q * n, bool)
        place = np.arange(q)
        flat = np.unique(np.concatenate([place * n + queries, place * n + _descended(x, lists, queries, medoids)]))
        while len(flat):
            seen[flat] = True
            query, node = np.divmod(flat, n)
            angle = np.arccos(np.clip(_cosines(x, queries[query], node), -1, 1))
            room = link + radius[queries[query]] + radius[node] - angle
            may = room >= -ROUNDING
            out[queries[query[may]], node[may]] = True
            walked = (room >= -SLACK) | (queries[query] == node)
            query, node = query[walked], node[walked]
            for first in range(0, len(query), 1 << 16):  # all neighbours, each new one once
                near = lists[node[first : first + (1 << 16)]]
                pair = query[first : first + (1 << 16), None] * n + near
                fresh[pair[near >= 0]] = True
            fresh &= ~seen
            flat = np.flatnonzero(fresh)
            fresh[flat] = False
    np.fill_diagonal(out, True)
    return out | out.T
