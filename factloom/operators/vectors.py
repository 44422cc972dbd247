"""Dense vectors: similarity, neighbours, centroids, medoids, sign hashes, sparse vectors.

Vectors are ARRAY<DOUBLE>; float input is cast before any arithmetic. All-pairs work runs as a join of a table with a set of
queries; the queries are broadcast only if their number is bounded by a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from factloom.operators.selection import first_by, top_by
from factloom.sources.checkpoints import bounded, cut


def doubles(v: str) -> Column:
    return F.col(v).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero if a vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def manhattan(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)


def unit(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, a).otherwise(F.transform(a, lambda x: x / n))


def average(df: DataFrame, keys: list[str], vector: str, weight: str | None = None, name: str = "centroid") -> DataFrame:
    """Weighted mean vector of each key. Sums are pre-aggregated by dimension before the shuffle."""
    w = F.col(weight) if weight else F.lit(1.0)
    long = df.select(*keys, w.alias("_w"), F.posexplode(doubles(vector)).alias("_d", "_x"))
    means = long.groupBy(*keys, "_d").agg((F.sum(F.col("_x") * F.col("_w")) / F.sum("_w")).alias("_m"))
    ordered = F.array_sort(F.collect_list(F.struct("_d", "_m")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda s: s["_m"]).alias(name))


#: Rows of a block of a tile join, and of a table of centroids that is broadcast.
BLOCK, BROADCAST = 5_000, 10_000


def blocks_of(df: DataFrame, rows: int = BLOCK) -> int:
    """How many blocks of so many rows the table makes."""
    return max(1, -(-df.count() // rows))


def scored(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, vector: str, rows: int = BLOCK) -> DataFrame:
    """(query, item, block, score): cosine of every query of a stated set with every item but itself. Vectors are made units once.

    A tile join on blocks of items, to each of which the queries go: no product, nothing is broadcast, and a task holds a
    block and the queries, whatever the size of the table.
    """
    n = blocks_of(items, rows)
    q = queries.select(F.col(query_id).alias("query"), unit(doubles(vector)).alias("_q"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"))
    i = items.select(F.col(item_id).alias("item"), unit(doubles(vector)).alias("_i"), F.pmod(F.xxhash64(item_id), F.lit(n)).cast("int").alias("block"))
    return q.join(i, "block").where("query != item").select("query", "item", "block", dot(F.col("_q"), F.col("_i")).alias("score"))


def top_neighbours(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, vector: str, k: int) -> DataFrame:
    """The k items of the largest cosine for each query of a stated query set, with ranks; ties by the smaller item."""
    s = scored(queries, items, query_id, item_id, vector).withColumn("score", F.round("score", 6))
    order = [F.col("score").desc(), F.col("item")]
    # The k best of each block first, so that a query sends k rows a block to the last ranking.
    return top_by(top_by(s, ["query", "block"], order, k).drop("rank", "block"), ["query"], order, k)


def sign_bands(df: DataFrame, item_id: str, vector: str, bands: int, width: int) -> DataFrame:
    """(band, value, item): sign bits of the first bands * width dimensions, ``width`` to a band, for candidate search."""
    v = doubles(vector)
    bits = F.transform(v, lambda x: F.when(x >= 0, "1").otherwise("0"))
    parts = [F.struct(F.lit(b).alias("band"), F.array_join(F.slice(bits, b * width + 1, width), "").alias("value")) for b in range(bands)]
    return df.select(F.col(item_id).alias("item"), F.inline(F.array(*parts)))


#: Rows of a block of which matrices of products are made, and numbers of such a matrix that are held at a time.
MATRIX_ROWS, MATRIX_CELLS = 20_000, 1 << 22


def _matrix(t: pa.Table, name: str, rows: np.ndarray) -> np.ndarray:
    """The vectors of some rows; all vectors of the column have one length and no nulls."""
    values = t.column(name).combine_chunks()
    flat = values.flatten().to_numpy()
    return flat.reshape(len(values), len(flat) // max(len(values), 1))[rows]


def _near_rows(a: list[np.ndarray], b: list[np.ndarray], least: list[float], within: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Pairs (i, j) of rows of a and b whose products are at least ``least`` in every feature, and these products.

    Units are expected. Single precision, with more room than it errs by, rules pairs out; a pair that is left, and one with
    a NaN, has its products added up in double precision in the order of ``dot``. The caller compares those exactly.
    within: a and b are the same rows, and j goes above i.
    """
    a32, b32 = ([x.astype(np.float32) for x in side] for side in (a, b))
    room = [1e-6 + 2.4e-7 * (x.shape[1] + 4) for x in a]
    step = max(1, MATRIX_CELLS // max(len(b[0]), 1))
    for at in range(0, len(a[0]), step):
        lo = at if within else 0
        ok = None
        for x, y, low, r in zip(a32, b32, least, room):
            may = ~(x[at : at + step] @ y[lo:].T < np.float32(low - r))
            ok = may if ok is None else ok & may
        i, j = np.nonzero(np.triu(ok, 1) if within else ok)
        for k in range(0, len(i), 1 << 18):
            p, q = i[k : k + (1 << 18)] + at, j[k : k + (1 << 18)] + lo
            sums = [np.zeros(len(p)) for _ in a]
            for x, y, total in zip(a, b, sums):
                for d in range(x.shape[1]):
                    total += x[p, d] * y[q, d]
            yield p, q, sums


def _whole(*vectors: str) -> Column:
    """Whether no vector and no value of one is null: others are like nothing."""
    out = F.lit(True)
    for v in vectors:
        out = out & F.forall(F.col(v), lambda x: x.isNotNull())
    return out


def _dealt(df: DataFrame, tiles: int, *keys: str) -> DataFrame:
    """df dealt by its tile, in a stated number of partitions, as few large tiles would else be put into one task."""
    return df.repartition(min(2 * tiles, 2_000), *keys)


def threshold_pairs(df: DataFrame, item_id: str, vector: str, least: float, rows: int = MATRIX_ROWS) -> DataFrame:
    """(a, b, score) with a < b and cosine at least ``least``: an exact tile join. Each pair of blocks of ``rows`` rows is a
    task's work of its own, so no task sees all pairs and nothing is broadcast; in a tile the products are one matrix."""
    blocks = max(4, blocks_of(df, rows))
    v = df.select(F.col(item_id).alias("id"), unit(doubles(vector)).alias("v"), F.pmod(F.xxhash64(item_id), F.lit(blocks)).cast("int").alias("g")).where(_whole("v"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tiles = v.withColumn("o", other).select("id", "v", F.size("v").alias("d"), "g", F.least("g", "o").alias("lo"), F.greatest("g", "o").alias("hi"))

    def pairs(t: pa.Table) -> pa.Table:
        g = t.column("g").to_numpy()
        left, right = np.flatnonzero(g == t.column("lo")[0].as_py()), np.flatnonzero(g == t.column("hi")[0].as_py())
        one = t.column("lo")[0] == t.column("hi")[0]
        found = [[np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]]
        for i, j, (score,) in _near_rows([_matrix(t, "v", left)], [_matrix(t, "v", right)], [least], one):
            for out, x in zip(found, (left[i], right[j], score)):
                out.append(x)
        i, j, score = (np.concatenate(x) for x in found)
        ids = t.column("id").combine_chunks()
        return pa.table({"x": ids.take(pa.array(i)), "y": ids.take(pa.array(j)), "score": score})

    kind = v.schema["id"].dataType.simpleString()
    near = _dealt(tiles, blocks * (blocks + 1) // 2, "d", "lo", "hi").groupBy("d", "lo", "hi").applyInArrow(pairs, f"x {kind}, y {kind}, score double")
    near = near.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.round("score", 6).alias("score"))
    return near.where(F.col("score") >= least)


def medoids(df: DataFrame, group: str, item_id: str, vector: str) -> DataFrame:
    """The member of the largest mean cosine to the others. It equals the mean against the sum of units, so no pairs are made."""
    u = df.select(group, F.col(item_id).alias("item"), unit(doubles(vector)).alias("v"))
    centre = average(u, [group], "v", name="c").join(u.groupBy(group).agg(F.count("*").alias("n")), group)
    mean = F.when(F.col("n") > 1, (F.col("n") * dot(F.col("v"), F.col("c")) - 1) / (F.col("n") - 1)).otherwise(1.0)
    scored_ = u.join(centre, group).select(group, "item", F.round(mean, 6).alias("mean_similarity"))
    return first_by(scored_, [group], [F.col("mean_similarity").desc(), "item"])


def group_sums(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Members and the similarity of all ordered pairs of different members: |sum of units|^2 - n."""
    u = df.select(group, unit(doubles(vector)).alias("v"))
    both = average(u, [group], "v", name="c").join(u.groupBy(group).agg(F.count("*").alias("n")), group)
    return both.select(group, "n", (F.col("n") * F.col("n") * dot(F.col("c"), F.col("c")) - F.col("n")).alias("total"))


def nearest_centroids(df: DataFrame, item_id: str, vector: str, centroids: DataFrame, label: str, k: int) -> DataFrame:
    """The k labels of the largest cosine for each row. ``centroids`` (label, centroid) is broadcast if it is counted to be
    small; beyond that rows go to each block of centroids, whose k best are ranked first."""
    i = df.select(F.col(item_id).alias("item"), doubles(vector).alias("v"))
    centroids, order = cut(centroids), [F.col("score").desc(), F.col(label)]
    score = F.round(cosine(F.col("v"), F.col("centroid")), 6).alias("score")
    n = blocks_of(centroids, BROADCAST)
    if n == 1:
        return top_by(i.crossJoin(F.broadcast(centroids)).select("item", label, score), ["item"], order, k)
    tiles = i.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(centroids.withColumn("block", F.pmod(F.xxhash64(label), F.lit(n)).cast("int")), "block")
    best = top_by(tiles.select("item", label, "block", score), ["item", "block"], order, k).drop("rank", "block")
    return top_by(best, ["item"], order, k)


def best_seed_set(df: DataFrame, item_id: str, label: str, vector: str) -> DataFrame:
    """(item, label, score): the label whose members have the highest mean cosine to the item, without the item itself.

    The mean against a label's members follows from the sum of their units, so no pairs are made.
    """
    u = df.select(F.col(item_id).alias("item"), F.col(label).alias("_own"), unit(doubles(vector)).alias("_u"))
    sets = average(u, ["_own"], "_u", name="_c").join(u.groupBy("_own").agg(F.count("*").alias("_n")), "_own").withColumnRenamed("_own", label)
    both = u.join(bounded(sets))  # a row for each label
    own = (F.col("_own") == F.col(label)).cast("int")
    mean = (F.col("_n") * dot(F.col("_u"), F.col("_c")) - own) / (F.col("_n") - own)
    scored_ = both.where(F.col("_n") > own).select("item", label, F.round(mean, 6).alias("score"))
    return first_by(scored_, ["item"], [F.col("score").desc(), label])


def weighted_match(parts: list[tuple[DataFrame, float]], limit: float) -> DataFrame:
    """Items near a query in every feature: weight * distance below ``limit`` for each; distances are added up.

    parts: (query, item, distance) of each feature with the feature's weight.
    """
    all_ = None
    for df, weight in parts:
        part = df.select("query", "item", (F.col("distance") * weight).alias("d")).where(F.col("d") < limit)
        all_ = part if all_ is None else all_.unionByName(part)
    return all_.groupBy("query", "item").agg(F.count("*").alias("n"), F.sum("d").alias("distance")).where(F.col("n") == len(parts)).drop("n")


def weighted_neighbours(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, features: list[tuple[str, float]], limit: float, rows: int = MATRIX_ROWS) -> DataFrame:
    """weighted_match of a stated query set with all other items, the distance of a feature (vector, weight) being 1 - cosine.

    A tile join on blocks of queries and of items; in a tile the products of all features are made side by side, so only pairs
    that are near in each of them leave the task.
    """
    names = [f"v{k}" for k in range(len(features))]
    vectors = [unit(doubles(v)).alias(n) for n, (v, _) in zip(names, features)]
    nq, ni = blocks_of(queries, rows), max(4, blocks_of(items, rows))
    own, every = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(F.col(query_id).alias("id"), *vectors, F.lit(True).alias("asks"), own(query_id, nq).alias("q"), every(ni).alias("i"))
    i = items.select(F.col(item_id).alias("id"), *vectors, F.lit(False).alias("asks"), own(item_id, ni).alias("i"), every(nq).alias("q"))
    tiles = q.unionByName(i).where(_whole(*names)).withColumn("d", F.array(*[F.size(n) for n in names]).cast("string"))
    least = [1 - limit / w if w > 0 else -np.inf for _, w in features]

    def pairs(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy()
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        ids, found = t.column("id").combine_chunks(), []
        for a, b, scores in _near_rows([_matrix(t, n, left) for n in names], [_matrix(t, n, right) for n in names], least):
            d = [(1 - s) * w for s, (_, w) in zip(scores, features)]
            ok = np.logical_and.reduce([x < limit for x in d])
            found.append((left[a[ok]], right[b[ok]], sum(x[ok] for x in d)))
        a, b, d = (np.concatenate(x) for x in zip((np.zeros(0, int), np.zeros(0, int), np.zeros(0)), *found))
        return pa.table({"query": ids.take(pa.array(a)), "item": ids.take(pa.array(b)), "distance": d})

    kind = tiles.schema["id"].dataType.simpleString()
    near = _dealt(tiles, nq * ni, "d", "q", "i").groupBy("d", "q", "i").applyInArrow(pairs, f"query {kind}, item {kind}, distance double")
    return near.where("query != item")


def sparse_cosine(a: DataFrame, b: DataFrame, a_id: str, b_id: str, key: str = "idx", value: str = "val") -> DataFrame:
    """(a_id, b_id, score) of sparse vectors in long form that share an index; other pairs have score zero and no row."""
    length = lambda df, i, n: df.groupBy(i).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias(n))
    x, y = a.select(a_id, key, F.col(value).alias("_x")), b.select(b_id, key, F.col(value).alias("_y"))
    dots = x.join(y, key).groupBy(a_id, b_id).agg(F.sum(F.col("_x") * F.col("_y")).alias("_dot"))
    out = dots.join(length(a, a_id, "_na"), a_id).join(length(b, b_id, "_nb"), b_id)
    return out.select(a_id, b_id, F.when(F.col("_na") * F.col("_nb") == 0, 0.0).otherwise(F.col("_dot") / (F.col("_na") * F.col("_nb"))).alias("score"))
