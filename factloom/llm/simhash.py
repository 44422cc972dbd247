"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are made in numpy over byte buffers. Distinct fingerprints are joined with themselves: two of them that differ
in at most three bits agree in one of four quarters, so each fingerprint goes to four groups keyed by a quarter, and in
each group a binary trie is walked pair of nodes by pair of nodes, adding up differing bits and dropping a pair as soon as
the budget is exceeded. A group above ``max_group`` is split the same way on the bits that are left, up to five times; by
then at most 2**16 different fingerprints can share a key, so no task holds an unbounded group and no link is lost. A task
returns a spanning forest of the links it found, never all pairs; components then come from star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from factloom.llm import texts as T
from factloom.llm.components import components, first_members
from factloom.llm.runtime import cut, ensure_importable, keep_rows, row_key

#: Bits left before each split and the widths of the four blocks they are cut into.
LEVELS = ((64, (16, 16, 16, 16)), (48, (12, 12, 12, 12)), (36, (9, 9, 9, 9)), (27, (7, 7, 7, 6)), (21, (6, 5, 5, 5)))
#: Pairs of nodes with at most so many pairs of leaves are compared leaf by leaf.
LEAF = 32
FRONTIER = 1 << 18


def fingerprints(arr: pa.Array, shingle: int = 3) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text; zero without words."""
    out = []
    for data, offsets in T.block_views(arr, 1 << 19):
        buf, start, end, first = T.squeezed(T.LOWER[data], offsets)
        words = np.diff(first)
        n = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
        row = T.owners(first)
        head = np.flatnonzero(np.arange(len(start)) - first[:-1][row] < n[row])
        tail = np.minimum(head + shingle - 1, first[1:][row[head]] - 1)
        counts = np.zeros((len(n), 64), np.int64)
        for lo in range(0, len(head), 1 << 15):
            h, t = head[lo : lo + (1 << 15)], tail[lo : lo + (1 << 15)]
            bits = np.unpackbits(T.xxh64(buf, start[h], end[t] - start[h]).view(np.uint8).reshape(-1, 8), axis=1)
            rows, at = np.unique(row[h], return_index=True)
            counts[rows] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out.append(np.packbits(2 * counts > n[:, None], axis=1).view(np.uint64).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprint_udf(shingle: int = 3):
    @F.arrow_udf("long")
    def fingerprint(text: pa.Array) -> pa.Array:
        return pa.array(fingerprints(text, shingle).view(np.int64))

    return fingerprint


class Forest:
    """Union-find over 0..n-1 whose links arrive in arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label[:] = up


def trie_links(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of codes of one group that differ in at most ``budget`` bits.

    codes: sorted within each group and distinct there; starts, ends: the groups. A trie node is a range of the sorted
    codes, so its children lie on the two sides of its first code with the next bit set.
    """
    zeros: dict[int, np.ndarray] = {}

    def split(level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if level not in zeros:
            z = np.zeros(len(codes) + 1, np.int32)
            np.cumsum((codes >> np.uint64(level)) & np.uint64(1) == 0, out=z[1:])
            zeros[level] = z
        return lo + zeros[level][hi] - zeros[level][lo]

    stack = [(bits - 1, np.stack([starts, ends, starts, ends, np.zeros_like(starts)]))]
    while stack:
        level, pairs = stack.pop()
        alo, ahi, blo, bhi, err = pairs
        small = (ahi - alo) * (bhi - blo) <= LEAF
        if small.any():
            a, na, b, nb = alo[small], (ahi - alo)[small], blo[small], (bhi - blo)[small]
            n = na * nb
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            nb_ = np.repeat(nb, n)
            i, j = np.repeat(a, n) + k // nb_, np.repeat(b, n) + k % nb_
            ok = np.bitwise_count(codes[i] ^ codes[j]) <= budget
            ok &= (i < j) | (np.repeat(a != b, n))
            if ok.any():
                yield i[ok], j[ok]
        alo, ahi, blo, bhi, err = pairs[:, ~small]
        if not len(alo):
            continue
        am, bm, same = split(level, alo, ahi), split(level, blo, bhi), (alo == blo) & (ahi == bhi)
        d = ~same
        nxt = np.concatenate([
            np.stack([alo, am, blo, bm, err]), np.stack([am, ahi, bm, bhi, err]), np.stack([alo, am, bm, bhi, err + 1]),
            np.stack([am[d], ahi[d], blo[d], bm[d], err[d] + 1]),
        ], axis=1)
        live = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3]) & (nxt[4] <= budget) & ~((nxt[0] == nxt[2]) & (nxt[1] == nxt[3]) & (nxt[1] - nxt[0] == 1))
        nxt = nxt[:, live]
        for lo in range(0, nxt.shape[1], FRONTIER):
            stack.append((level - 1, nxt[:, lo : lo + FRONTIER]))


def _forest_links(key: np.ndarray, code: np.ndarray, node: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((code, key))
    key, code, node = key[order], code[order], node[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[starts[1:], len(key)]
    several = ends - starts > 1
    forest = Forest(len(key))
    for i, j in trie_links(code, starts[several], ends[several], bits, budget):
        forest.link(i, j)
    tied = np.flatnonzero(forest.label != np.arange(len(key)))
    return node[tied], node[forest.label[tied]]


def _join_partition(batches: Iterator[pa.RecordBatch], bits: int, budget: int, rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Links of the groups of a partition, which arrive sorted by key; whole groups are held, ``rows`` rows or one group at a time."""
    held: list[np.ndarray] = []
    size = 0

    def made(part: np.ndarray) -> pa.RecordBatch:
        a, b = _forest_links(part[0], part[1].view(np.uint64), part[2], bits, budget)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]))
        size += batch.num_rows
        if size >= rows:
            part = np.concatenate(held, axis=1)
            last = int(np.searchsorted(part[0], part[0, -1]))
            if last:
                yield made(part[:, :last])
            held, size = [part[:, last:]], part.shape[1] - last
    if size:
        yield made(np.concatenate(held, axis=1))


def _keys(rows: DataFrame, level: int) -> DataFrame:
    """Four rows for each row: a block of its bits goes to the key, the others stay as code."""
    bits, widths = LEVELS[level]
    shift, options = bits, []
    for j, width in enumerate(widths):
        shift -= width
        block = F.shiftrightunsigned("code", shift).bitwiseAND((1 << width) - 1)
        above = F.shiftleft(F.shiftrightunsigned("code", shift + width), shift) if j else F.lit(0).cast("long")
        below = F.col("code").bitwiseAND((1 << shift) - 1)
        key = F.shiftleft("key", widths[0] + 2).bitwiseOR(F.lit(j << widths[0]).cast("long")).bitwiseOR(block)
        options.append(F.struct(key.alias("key"), above.bitwiseOR(below).alias("code"), F.col("node").alias("node")))
    return rows.select(F.inline(F.array(*options)))


def similar_links(nodes: DataFrame, budget: int = 3, max_group: int = 8192) -> DataFrame:
    """(a, b): a spanning forest of the links between nodes whose fingerprints differ in at most ``budget`` bits.

    nodes: node long, fp long, with distinct fp. budget: 0 to 3, as four blocks leave one without differences.
    """
    if not 0 <= budget < 4:
        raise ValueError("budget must be 0 to 3")
    rows, parts = nodes.select(F.lit(0).cast("long").alias("key"), F.col("fp").alias("code"), "node"), []
    for level, (bits, widths) in enumerate(LEVELS):
        groups = _keys(rows, level)
        left = bits - min(widths)
        if level < len(LEVELS) - 1:
            hot = cut(groups.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_group).select("key"))
            some = not hot.isEmpty()
            # The first level has 4 * 2**16 keys at most, so its hot keys take a few MB at any size of the input.
            hint = F.broadcast(hot) if level == 0 else hot
            cold = groups.join(hint, "key", "left_anti") if some else groups
        else:
            some, cold = False, groups
        cold = cold.repartition("key").sortWithinPartitions("key")
        parts.append(cold.mapInArrow(lambda it, bits=left: _join_partition(it, bits, budget), "a long, b long"))
        if not some:
            break
        rows = cut(groups.join(hint, "key", "left_semi"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _classes(prints: DataFrame, budget: int, max_group: int) -> DataFrame:
    """(fp, first): each fingerprint with the least (id, fingerprint) of its component. prints: id, fp."""
    every = cut(prints.groupBy("fp").agg(F.min("id").alias("node")))
    nodes = every.where("node is not null")
    # A fingerprint is its own node, as one id may have several texts.
    tied = components(similar_links(nodes.select(F.col("fp").alias("node"), "fp"), budget, max_group), "a", "b")
    labels = first_members(tied, nodes)
    return every.join(labels, "fp", "left").select("fp", F.coalesce("first", F.struct("node", "fp")).alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = 3, max_group: int = 8192) -> DataFrame:
    """(id_col, fingerprint string, component_id): every row of docs with its fingerprint and its near-duplicate component.

    Null, empty and blank texts have fingerprint zero, which is linked like any other. Repeated rows and ids stay as they
    are; a null id keeps its row, and a fingerprint whose ids are all null has a null component. Other columns, whatever
    their names, are not read.
    """
    ensure_importable(docs.sparkSession)
    prints = cut(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), fingerprint_udf(shingle)(F.col(f"`{text_col}`")).alias("fp")))
    return prints.join(_classes(prints, budget, max_group), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.node").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = 3, max_group: int = 8192) -> DataFrame:
    """docs with one row of each component: the one with the smallest id, and of rows with that id the one with the least
    fingerprint and then the least hash of its text. Rows that share an id but not the text are told apart.

    Of rows equal in id and text the one with the least hash of all columns but maps stays. Rows with a null id are kept, as
    there is nothing to tell them by.
    """
    ensure_importable(docs.sparkSession)
    prints = cut(docs.select(row_key(id_col, text_col).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), fingerprint_udf(shingle)(F.col(f"`{text_col}`")).alias("fp")))
    rows = prints.where("id is not null").groupBy("row").agg(F.any_value("id").alias("id"), F.any_value("fp").alias("fp"), F.count("*").alias("times"))
    rows = rows.join(_classes(prints, budget, max_group), "fp").withColumn("may", F.struct(F.col("id").alias("node"), "fp") == F.col("first"))
    # Texts of one id may share a fingerprint: the one with the least hash stays.
    least = rows.where("may").groupBy("id", "fp").agg(F.min("row").alias("least"))
    rows = rows.join(least, ["id", "fp"], "left").select("row", "times", F.coalesce(F.col("may") & (F.col("row") == F.col("least")), F.lit(False)).alias("stays"))
    return keep_rows(docs, row_key(id_col, text_col), cut(rows))
