"""Agglomerative clustering and clustering by committee. Groups are clustered in parallel; the vectors of a group must fit in
a task, their similarities need not: those of unit vectors follow from sums of vectors, and are made in blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def hac(similarity: np.ndarray, floor: float = 0.0) -> list[tuple[tuple[int, ...], tuple[int, ...], float]]:
    """Merges (members, members, average similarity after the merge) of average-group clustering.

    The pair with the largest average similarity of ordered pairs is merged until one cluster is left or the best is not
    above ``floor``. Sums of a merged cluster are those of its parts, so a merge costs one row; ties go to the earlier pair.
    """
    n = len(similarity)
    cross = similarity.astype(float).copy()
    np.fill_diagonal(cross, 0)
    within, size, members, live, out = np.zeros(n), np.ones(n), [(k,) for k in range(n)], np.ones(n, bool), []
    while live.sum() > 1:
        idx = np.flatnonzero(live)
        total = within[idx][:, None] + within[idx][None, :] + 2 * cross[np.ix_(idx, idx)]
        m = size[idx][:, None] + size[idx][None, :]
        score = total / (m * (m - 1))
        score[np.tril_indices(len(idx))] = -np.inf
        a, b = np.unravel_index(int(score.argmax()), score.shape)
        best = score[a, b]
        if best <= floor:
            break
        i, j = idx[a], idx[b]
        out.append((members[i], members[j], float(best)))
        within[i] += within[j] + 2 * cross[i, j]
        cross[i] += cross[j]
        cross[:, i] += cross[:, j]
        cross[i, i] = 0
        size[i] += size[j]
        members[i] = tuple(sorted(members[i] + members[j]))
        live[j] = False
    return out


def hac_units(units: np.ndarray, floor: float = 0.0, listed: int = 12, cells: int = 1 << 20) -> list[tuple[int, int, float]]:
    """Merges (least member, least member, average similarity) of ``hac`` over the products of unit (or zero) vectors.

    The sum of similarities between clusters is the product of their sums of vectors, so memory goes with the number of
    vectors. Each cluster has a list of its best partners and a bound on its scores with all others. A merge takes two from
    the lists and may bring in the merged cluster; a cluster whose list has nothing above its bound is looked at again once
    that bound is the largest of all. Scores are rounded to 12 digits, so that equal ones are ties.
    """
    n = len(units)
    total = units.astype(float).copy()
    within, size, head, gone = np.zeros(n), np.ones(n), np.arange(n), np.zeros(n, bool)
    best, partner, bound, known = np.full(n, -np.inf), np.full(n, -1), np.full(n, -np.inf), np.zeros(n, bool)
    value, other = np.full((n, listed), -np.inf), np.full((n, listed), -1)

    def scores(rows: np.ndarray) -> np.ndarray:
        m = size + size[rows, None]
        out = np.round((within + within[rows, None] + 2 * (total[rows] @ total.T)) / (m * (m - 1)), 12)
        out[:, gone] = -np.inf
        out[np.arange(len(rows)), rows] = -np.inf
        return out

    def look(rows: np.ndarray) -> None:
        x = scores(rows)
        partner[rows], best[rows], known[rows] = x.argmax(axis=1), x.max(axis=1), True
        bound[rows], value[rows] = -np.inf, -np.inf
        if x.shape[1] > listed:
            top = np.argpartition(x, -listed - 1, axis=1)[:, -listed - 1 :]
            v = np.take_along_axis(x, top, 1)
            bound[rows], value[rows], other[rows] = v[:, 0], v[:, 1:], top[:, 1:]
        else:
            value[rows, : x.shape[1]], other[rows, : x.shape[1]] = x, np.arange(x.shape[1])

    step = max(1, cells // max(n, 1))
    for at in range(0, n, step):
        look(np.arange(at, min(at + step, n)))
    out = []
    while n > 1:
        i = int(best.argmax())
        if best[i] <= floor:
            break
        if not known[i]:
            first = np.flatnonzero(~known & (best >= best[known].max(initial=-np.inf)))
            look(first[np.argsort(-best[first], kind="stable")[: max(1, min(64, step))]])
            continue
        j, top = int(partner[i]), float(best[i])
        if j < i:
            i, j = j, i
        out.append((int(head[i]), int(head[j]), top))
        within[i] += within[j] + 2 * float(total[i] @ total[j])
        total[i] += total[j]
        size[i] += size[j]
        gone[j], total[j] = True, 0
        row = scores(np.array([i]))[0]
        value[(other == i) | (other == j)] = -np.inf
        lost = (partner == i) | (partner == j)
        over = known & ~lost & ((row > best) | ((row == best) & (partner > i)))
        best[over], partner[over] = row[over], i
        # The merged cluster goes into the lists, in place of the last one there.
        into = np.flatnonzero(row > bound)
        slot = value[into].argmin(axis=1)
        last = value[into, slot]
        up = row[into] > last
        bound[into] = np.maximum(bound[into], np.minimum(last, row[into]))
        value[into[up], slot[up]], other[into[up], slot[up]] = row[into[up]], i
        open_ = np.flatnonzero((lost | ~known) & ~gone)
        m = value[open_].max(axis=1)
        known[open_] = m > bound[open_]
        best[open_] = np.maximum(m, bound[open_])
        partner[open_] = np.where(value[open_] == m[:, None], other[open_], n).min(axis=1)
        best[j], known[j] = -np.inf, True
        look(np.array([i]))
        if gone.mean() > 0.3:
            live = np.flatnonzero(~gone)
            at = np.append(np.cumsum(~gone) - 1, -1)
            partner, other, n = at[partner[live]], at[other[live]], len(live)
            total, within, size, head, best, bound, known, value, gone = (x[live] for x in (total, within, size, head, best, bound, known, value, gone))
    return out


def best_cohesion(similarity: np.ndarray) -> tuple[tuple[int, ...], float]:
    """The cluster of the tree whose n * average similarity is largest."""
    best: tuple[tuple[int, ...], float] = ((0,) if len(similarity) else (), 0.0)
    for a, b, avg in hac(similarity):
        both = tuple(sorted(a + b))
        if len(both) * avg > best[1]:
            best = both, len(both) * avg
    return best


def committees(similarity: np.ndarray, k: int = 50, committee_threshold: float = 0.35, residue_threshold: float = 0.25, rounds: int = 10) -> list[tuple[int, ...]]:
    """Committees: for each member the most cohesive cluster of its k nearest, kept in order of cohesion while they are
    unlike those kept before; members that no committee covers are treated again by themselves."""
    kept: list[tuple[int, ...]] = []
    left = np.arange(len(similarity))
    for _ in range(rounds):
        found = {}
        for i in left:
            order = [j for j in left[np.argsort(-similarity[i, left], kind="stable")] if j != i][:k]
            if order:
                best, cohesion = best_cohesion(similarity[np.ix_(order, order)])
                found[tuple(sorted(order[x] for x in best))] = cohesion
        if not found:
            break
        values = np.array(list(found.values()))
        floor = max(values.mean() - values.std(), 0)
        new = []
        for c, cohesion in sorted(found.items(), key=lambda x: (-x[1], x[0])):
            if cohesion >= floor and all(similarity[np.ix_(c, d)].mean() <= committee_threshold for d in (*kept, *new)):
                new.append(c)
        if not new:
            break
        kept += new
        near = np.array([max(similarity[i, list(c)].mean() for c in kept) for i in left])
        rest = left[near < residue_threshold]
        if not len(rest) or len(rest) == len(left):
            break
        left = rest
    return kept


def assign(similarity: np.ndarray, groups: list[tuple[int, ...]]) -> np.ndarray:
    """Group of the largest average similarity above zero for each member, its own committee for a committee's member; else -1."""
    out = np.full(len(similarity), -1)
    for g, members in enumerate(groups):
        for m in members:
            if out[m] < 0:
                out[m] = g
    for i in np.flatnonzero(out < 0):
        scores = np.array([similarity[i, [m for m in c if m != i]].mean() for c in groups]) if groups else np.zeros(0)
        if len(scores) and scores.max() > 0:
            out[i] = int(scores.argmax())
    return out


def best_cohesions(similarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """best_cohesion of many similarity matrices (b, n, n) at once: members (b, n) boolean, and values (b)."""
    b, n, _ = similarity.shape
    cross, at, cols = similarity.astype(float).copy(), np.arange(b), np.arange(n)
    cross[:, cols, cols] = 0
    within, size, owner, dead = np.zeros((b, n)), np.ones((b, n)), np.tile(cols, (b, 1)), np.zeros((b, n), bool)
    score = np.where(cols[:, None] < cols, cross, -np.inf)
    best, members = np.zeros(b), np.zeros((b, n), bool)
    members[:, :1] = True
    for _ in range(n - 1):
        flat = score.reshape(len(at), -1).argmax(axis=1)
        k, i, j = np.arange(len(at)), flat // n, flat % n
        top = score[k, i, j]
        if not (top > 0).all():
            on = top > 0
            cross, within, size, owner, dead, score, at, i, j, top = (x[on] for x in (cross, within, size, owner, dead, score, at, i, j, top))
            k = np.arange(len(at))
            if not len(at):
                break
        within[k, i] += within[k, j] + 2 * cross[k, i, j]
        cross[k, i] += cross[k, j]
        cross[k, :, i] = cross[k, i]
        cross[k, i, i] = 0
        size[k, i] += size[k, j]
        owner = np.where(owner == j[:, None], i[:, None], owner)
        dead[k, j] = True
        m = size + size[k, i][:, None]
        new = np.where(dead, -np.inf, (within + within[k, i][:, None] + 2 * cross[k, i]) / (m * (m - 1)))
        score[k, i] = np.where(cols > i[:, None], new, -np.inf)
        score[k, :, i] = np.where(cols < i[:, None], new, -np.inf)
        score[k, j], score[k, :, j] = -np.inf, -np.inf
        value = size[k, i] * top
        better = value > best[at]
        best[at[better]], members[at[better]] = value[better], owner[better] == i[better, None]
    return members, best


def nearest_rows(units: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """(rows, k): for each of ``rows`` the k nearest others of them, nearest first; ties go to the earlier one."""
    x, out = units[rows], []
    k = min(k, len(rows) - 1)
    step = max(1, (1 << 21) // max(len(rows), 1))
    for at in range(0, len(rows), step):
        s = x[at : at + step] @ x.T
        own = np.arange(len(s))
        s[own, at + own] = -np.inf
        least = np.partition(s, len(rows) - k, axis=1)[:, len(rows) - k, None]
        row, top = np.nonzero(s >= least)
        if len(top) > k * len(s):  # several at the least similarity: the earlier ones
            over, tied = s > least, s == least
            row, top = np.nonzero(over | (tied & (np.cumsum(tied, axis=1) <= k - over.sum(axis=1, keepdims=True))))
        top = top.reshape(len(s), k)
        out.append(np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1))
    return rows[np.concatenate(out)]


def committees_of_units(units: np.ndarray, k: int = 50, committee_threshold: float = 0.35, residue_threshold: float = 0.25, rounds: int = 10) -> list[tuple[int, ...]]:
    """``committees`` over the products of unit vectors: neighbours are sought in blocks, their trees are made many at a time,
    and the average similarity of two groups is the product of their mean vectors."""
    kept: list[tuple[int, ...]] = []
    means = np.zeros((0, units.shape[1]))
    left = np.arange(len(units))
    for _ in range(rounds):
        if len(left) < 2 or k < 1:
            break
        found: dict[tuple[int, ...], float] = {}
        near = nearest_rows(units, left, k)
        for at in range(0, len(near), 64):
            order = near[at : at + 64]
            s = units[order] @ units[order].transpose(0, 2, 1)
            members, cohesion = best_cohesions((s + s.transpose(0, 2, 1)) / 2)
            found.update((tuple(np.sort(o[m]).tolist()), c) for o, m, c in zip(order, members, cohesion.tolist()))
        values = np.array(list(found.values()))
        floor = max(values.mean() - values.std(), 0)
        ranked = [c for c, cohesion in sorted(found.items(), key=lambda x: (-x[1], x[0])) if cohesion >= floor]
        before = len(kept)
        for at in range(0, len(ranked), 256):
            block = ranked[at : at + 256]
            mean = np.stack([units[list(c)].mean(axis=0) for c in block])
            # Those like a committee of an earlier block go at once; the others are held against those that this block adds.
            unlike, new = np.flatnonzero((mean @ means.T).max(axis=1, initial=-np.inf) <= committee_threshold), []
            while len(unlike):
                new.append(unlike[0])
                unlike = unlike[1:][mean[unlike[1:]] @ mean[unlike[0]] <= committee_threshold]
            kept += [block[x] for x in new]
            means = np.vstack([means, mean[new]])
        if len(kept) == before:
            break
        like = np.concatenate([(units[left[at : at + 4096]] @ means.T).max(axis=1) for at in range(0, len(left), 4096)])
        rest = left[like < residue_threshold]
        if not len(rest) or len(rest) == len(left):
            break
        left = rest
    return kept


def assign_units(units: np.ndarray, groups: list[tuple[int, ...]]) -> np.ndarray:
    """``assign`` over the products of unit vectors."""
    out = np.full(len(units), -1)
    for g in reversed(range(len(groups))):
        out[list(groups[g])] = g
    free = np.flatnonzero(out < 0)
    if groups:
        means = np.stack([units[list(c)].mean(axis=0) for c in groups])
        for at in range(0, len(free), 4096):
            scores = units[free[at : at + 4096]] @ means.T
            out[free[at : at + 4096]] = np.where(scores.max(axis=1) > 0, scores.argmax(axis=1), -1)
    return out


def _units(vectors: pd.Series) -> np.ndarray:
    v = np.stack([np.asarray(x, float) for x in vectors]) if len(vectors) else np.zeros((0, 1))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _by_group(df: DataFrame, group: str, run, schema: str) -> DataFrame:
    """Groups dealt over a stated number of partitions, as a few small ones would else be put into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), group).groupBy(group).applyInPandas(run, schema)


def hac_by_group(df: DataFrame, group: str, item: str, vector: str, stop: float = 0.0) -> DataFrame:
    """(group, item, cluster): clusters left when the best merge is not above ``stop``; named by their smallest item."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(item).reset_index(drop=True)
        owner = np.arange(len(pdf))
        # Backwards: what a cluster is merged into later is known first.
        for a, b, _ in reversed(hac_units(_units(pdf[vector]), stop)):
            owner[b] = owner[a]
        return pd.DataFrame({group: pdf[group], item: pdf[item], "cluster": pdf[item].to_numpy()[owner]})

    kind = dict(df.dtypes)
    return _by_group(df.select(group, item, vector), group, run, f"{group} {kind[group]}, {item} {kind[item]}, cluster {kind[item]}")


def cbc_by_group(df: DataFrame, group: str, item: str, vector: str, **options) -> DataFrame:
    """(group, item, committee): clustering by committee within each group; -1 for members like none."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(item).reset_index(drop=True)
        u = _units(pdf[vector])
        return pd.DataFrame({group: pdf[group], item: pdf[item], "committee": assign_units(u, committees_of_units(u, **options))})

    kind = dict(df.dtypes)
    return _by_group(df.select(group, item, vector), group, run, f"{group} {kind[group]}, {item} {kind[item]}, committee int")


def farthest_first(vectors: np.ndarray, n: int) -> list[int]:
    """Start at the vector of the largest mean similarity, then add the one least like those chosen."""
    s = vectors @ vectors.T
    chosen = [int(s.mean(axis=1).argmax())]
    near = s[chosen[0]].copy()
    while len(chosen) < min(n, len(vectors)):
        near[chosen] = np.inf
        k = int(near.argmin())
        chosen.append(k)
        near = np.maximum(np.where(np.isinf(near), -np.inf, near), s[k])
    return chosen
