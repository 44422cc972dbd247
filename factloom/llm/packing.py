"""Vector bin packing of token sequences.

An item has three demands: tokens, segments (one) and loss-bearing tokens; a sequence has a limit for each. One sequence is
open at a time, and the item whose demand has the largest dot product with the sequence's remaining room goes in next. When
nothing fits any more, an item is cut to fill what is left. Each input partition is packed by itself, from a pool of bounded
size, so there is no shuffle and no state that grows; a task that is run again makes the same sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from factloom.llm.runtime import ensure_importable


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


@dataclass
class Item:
    """A run of an example's tokens from ``start`` on that is not placed yet; loss[k] counts loss-bearing ones among its first k."""

    owner: object
    start: int
    length: int
    loss: np.ndarray | None  # None: every token but the example's first is loss-bearing

    def demand(self, length: int | None = None) -> int:
        n = self.length if length is None else length
        if self.loss is None:
            return n - (1 if self.start == 0 and n else 0)
        return int(self.loss[self.start + n] - self.loss[self.start])

    def fitting(self, tokens: int, loss: int) -> int:
        """Tokens of its head that fit in so many tokens and loss-bearing tokens."""
        n = min(self.length, tokens)
        if self.demand(n) <= loss:
            return n
        if self.loss is None:
            return min(n, loss + (1 if self.start == 0 else 0))
        return int(np.searchsorted(self.loss, self.loss[self.start] + loss, "right")) - 1 - self.start

    def head(self, n: int) -> tuple[Item, Item | None]:
        rest = Item(self.owner, self.start + n, self.length - n, self.loss) if n < self.length else None
        return Item(self.owner, self.start, n, self.loss), rest


def _power_parts(n: int) -> list[int]:
    """Powers of two, largest first, that add up to n."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(items: Iterator[Item], limits: Limits, cut: bool = True, pool_size: int = 256) -> Iterator[list[Item]]:
    """Sequences, each a list of pieces. Without ``cut`` no item is divided; one above a limit is a sequence of its own.

    With ``cut``, a last sequence that is not full is divided into sequences whose lengths are powers of two.
    """
    size = np.array([limits.tokens, limits.segments, limits.loss], float)
    pool: list[Item | None] = []
    demand = np.zeros((pool_size, 3))
    used, free = 0, list(range(pool_size))
    pool = [None] * pool_size

    def put(item: Item) -> None:
        nonlocal used
        k = free.pop()
        pool[k] = item
        demand[k] = item.length, 1, item.demand()
        used += 1

    def take(k: int) -> Item:
        nonlocal used
        item, pool[k] = pool[k], None
        demand[k] = np.inf
        free.append(k)
        used -= 1
        return item

    demand[:] = np.inf

    def sequence() -> list[Item]:
        left, out = size.copy(), []
        while used:
            fits = (demand <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, np.where(fits[:, None], demand / size, 0) @ (left / size), -1)
                item = take(int(score.argmax()))
            elif cut and left[0] >= 1 and left[1] >= 1:
                # Of the items that are too large, the largest: its head fills the sequence.
                k = int(np.where(np.isfinite(demand[:, 0]), demand[:, 0], -1).argmax())
                n = pool[k].fitting(int(left[0]), int(left[2]))
                if n < 1:
                    break
                item, rest = take(k).head(n)
                if rest is not None:
                    put(rest)
            elif not out:
                item = take(int(np.flatnonzero(np.isfinite(demand[:, 0]))[0]))
                return [item]
            else:
                break
            out.append(item)
            left -= (item.length, 1, item.demand())
        return out

    for item in items:
        while cut and item is not None and item.length >= limits.tokens:
            n = item.fitting(limits.tokens, limits.loss)
            if n < limits.tokens:
                break
            piece, item = item.head(n)
            yield [piece]
        if item is None:
            continue
        if not cut and (item.length > limits.tokens or item.demand() > limits.loss):
            yield [item]
            continue
        while not free:
            yield sequence()
        put(item)
    while used:
        out = sequence()
        total = sum(x.length for x in out)
        if not cut or total == limits.tokens or total & (total - 1) == 0:
            yield out
            continue
        queue = list(out)
        for part in _power_parts(total):
            seq = []
            while part:
                item = queue.pop(0)
                piece, rest = item.head(min(part, item.length))
                if rest is not None:
                    queue.insert(0, rest)
                part -= piece.length
                seq.append(piece)
            yield seq


#: Characters on whose classes all regular-expression engines agree; other texts take the reference path of Tokens.
_PLAIN = re.compile("[^\n\t\x20-\x7e\xa1-\xac\xae-ɏ‐-‧€]")
_tokens: dict[str, Tokens] = {}


class Tokens:
    """Ids of the vocabulary in a tokenizers JSON file, without special tokens.

    Where a file of the same name with the ranks of the same byte-level vocabulary lies beside it, plain texts go through a
    faster encoder of that vocabulary, which gives the same ids.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        self.path, self.full, self.fast = path, None, None
        if ranks:
            import tiktoken

            pairs = (line.split() for line in open(ranks, "rb"))
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not _PLAIN.search(text) and "<|" not in text:
            return self.fast.encode_ordinary(text)
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.path)
        return self.full.encode(text, add_special_tokens=False).ids

    @classmethod
    def named(cls, name: str) -> Tokens:
        """name: a file of the installed public tokenizers, or a path."""
        if name not in _tokens:
            if "/" in name:
                _tokens[name] = cls(name, None, None)
            else:
                import public_tokenizers as P

                ranks = P.path(name.removesuffix(".json") + ".tiktoken") if name == "byte_bpe_50k.json" else None
                _tokens[name] = cls(P.path(name), ranks, P.PATTERN)
        return _tokens[name]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def _rows(sequences: Iterator[list[Item]], crc, schema: str = PIECES) -> Iterator[pa.RecordBatch]:
    """Rows of PIECES, and after them what an owner has beside its id, number of tokens and ids."""
    base = TaskContext.get().partitionId() << 33
    names = [x.split()[0] for x in schema.split(", ")]
    rows: list[tuple] = []
    for k, seq in enumerate(sequences):
        offset = 0
        for x in seq:
            doc_id, total, ids, *more = x.owner
            rows.append((doc_id, x.start, x.length, crc(ids, x), total, base + k, offset, x.demand(), *more))
            offset += x.length
        if len(rows) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def pack_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", limits: Limits = Limits(), end_id: int = 0) -> DataFrame:
    """Every text's ids, with ``end_id`` after them, in sequences under all limits; one row for each piece (PIECES).

    A null or empty text has ``end_id`` alone. Repeated rows are packed as often as they occur; a null id is returned as
    null. Other columns are not read.
    """
    ensure_importable(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokens.named(tokenizer)

        def items() -> Iterator[Item]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for k, text in enumerate(batch.column(1)):
                    got = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                    yield Item((ids[k], len(got), got), 0, len(got), None)

        yield from _rows(pack(items(), limits), lambda ids, x: zlib.crc32(ids[x.start : x.start + x.length].tobytes()))

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(packed, PIECES)


def pack_conversations(
    turns: DataFrame, tokenizer: str = "byte_bpe_50k.json", limits: Limits = Limits(), loss_roles: tuple[str, ...] = ("assistant",), end_id: int = 0, max_turns: int = 1024,
) -> DataFrame:
    """Instruction data: the turns of a conversation in order are one example; only tokens of ``loss_roles`` bear loss.

    turns: conv_id, turn, role, text. An example is not cut unless it exceeds a limit by itself. Returns PIECES with conv_id
    as doc_id, and part long. Null texts are empty turns. Turns with one number are ordered by role and text, a null number
    comes first. A conversation is divided after every ``max_turns`` turn numbers, so a conversation with a large share of
    all turns is an example for each part (0, 1, ...), with starts and doc_tokens of its own, and no task gathers more.
    Other columns, whatever their names, are not read.
    """
    ensure_importable(turns.sparkSession)
    part = F.coalesce(F.floor(F.col("turn") / max_turns), F.lit(0)).cast("long")
    convs = turns.groupBy("conv_id", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    schema = PIECES + ", part long"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokens.named(tokenizer)

        def items() -> Iterator[Item]:
            for batch in batches:
                for conv_id, part, said in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    ids, loss = [], []
                    for turn in said:
                        got = [*encode(turn["text"] or ""), end_id]
                        ids += got
                        loss += [turn["role"] in loss_roles] * len(got)
                    yield Item((conv_id, len(ids), np.array(ids, "<u4"), part), 0, len(ids), np.r_[0, np.cumsum(loss)])

        def whole() -> Iterator[Item]:
            for x in items():
                while x is not None and (x.length > limits.tokens or x.demand() > limits.loss):
                    head, x = x.head(max(1, x.fitting(limits.tokens, limits.loss)))
                    yield head
                if x is not None:
                    yield x

        yield from _rows(pack(whole(), limits, cut=False), lambda ids, x: zlib.crc32(ids[x.start : x.start + x.length].tobytes()), schema)

    return convs.select(F.col("conv_id").cast("long"), "part", "turns").mapInArrow(packed, schema)
