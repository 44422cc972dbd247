"""Statistics of documents for the tree models, and the base counts of the quality rules, in numpy over byte buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from factloom.llm import texts as T

WINDOW = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CLASSES = {
    "upper": list(range(0x41, 0x5B)), "lower": list(range(0x61, 0x7B)), "digit": list(range(0x30, 0x3A)), "bang": list(b"!?"),
    "pipe": list(b"|"), "stop": list(b"."), "comma": list(b",;:"), "bracket": list(b"{}[]()=_\\/<>"), "symbol": list(b"#*$%&|<>~^@+"),
}
#: Frequent function words of the languages that the corpus may hold.
STOPWORDS = (
    "the of and to in is that for on with as was are be this by it from at or an a not have has his her they we you he she but which "
    "de la le les des du et en un une que qui dans pour pas sur est par au avec il elle ne se "
    "der die das und ist von den mit sich des auf für im dem nicht ein eine zu als auch "
    "el los las del y por con una su para es al lo como más pero sus"
).split()
_STOP = np.unique(np.array([T.hash_of(w.encode()) for w in STOPWORDS], np.uint64))

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbols", "upper", "digit", "bang", "pipe", "stop", "comma", "bracket", "non_ascii", "dup_lines",
    "repeat_words", "distinct_words", "stop_words", "short_lines", "words_a_line", "caps_words", "same_word_runs",
)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, spans: T.SpanHash, word_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word, those equal to an earlier one of their text, and those of fewer than 20 bytes, for each row."""
    rows = len(offsets) - 1
    member = data != 0x0A
    start, end, first = T.runs(member, offsets)
    # A line has a word if a word starts in it; line breaks are separators, so no word crosses a line.
    words = np.searchsorted(word_start, end) - np.searchsorted(word_start, start)
    row = T.owners(first)
    ok = words > 0
    row, h, short = row[ok], spans(start[ok], end[ok]), (end - start)[ok] < 20
    keys = h ^ T.mixed(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    again = np.r_[False, keys[order][1:] == keys[order][:-1]] if len(keys) else np.zeros(0, bool)
    return np.bincount(row, minlength=rows), np.bincount(row[order][again], minlength=rows), np.bincount(row[short], minlength=rows)


def measure(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text: the BASE counts (int64) and the FEATURES (float32)."""
    base, feats = [], []
    for data, offsets in T.block_views(arr, 1 << 20):
        rows = len(offsets) - 1
        start, end, first = T.runs(~T.SPACE[data], offsets)
        row, n_words = T.owners(first), np.diff(first)
        spans = T.SpanHash(data)
        words = spans(start, end)
        n_bytes = np.maximum(np.diff(offsets), 1)
        space = T.count_by_row(T.SPACE[data], offsets)
        cont = T.count_by_row((data & 0xC0) == 0x80, offsets)
        word_chars = np.diff(offsets) - space - cont
        n_symbols = T.count_by_row(_SYMBOL[data], offsets)
        lines, dup_lines, short = _dup_lines(data, offsets, spans, start)
        # A window of five words is hashed from its words' hashes.
        covered = np.zeros(len(start) + 1, np.int64)
        if len(start) >= WINDOW:
            last = len(start) - WINDOW + 1
            h = np.zeros(last, np.uint64)
            for k in range(WINDOW):
                h = T.mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + last])
            inside = np.flatnonzero(row[:last] == row[WINDOW - 1 :])
            twice = inside[T.repeated(h[inside] ^ T.mixed(row[inside].astype(np.uint64) + np.uint64(1)))]
            np.add.at(covered, twice, 1)
            np.add.at(covered, twice + WINDOW, -1)
        repeat = T.count_by_row(np.cumsum(covered[:-1]) > 0, first) if len(start) else np.zeros(rows, np.int64)
        base.append(np.stack([n_words, word_chars, n_symbols, dup_lines, repeat], axis=1))
        distinct = _distinct(words, row, rows)
        w = np.maximum(n_words, 1)
        frac = {k: T.count_by_row(_table(v)[data], offsets) / n_bytes for k, v in _CLASSES.items()}
        stops = np.bincount(row[np.isin(words, _STOP)], minlength=rows) / w
        upper = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_table(_CLASSES["upper"])[data], out=upper[1:])
        caps = np.bincount(row[(upper[end] - upper[start] >= 2)], minlength=rows) / w
        same = np.bincount(row[1:][(words[1:] == words[:-1]) & (row[1:] == row[:-1])], minlength=rows) / w if len(words) else np.zeros(rows)
        feats.append(np.stack([
            np.log1p(n_words), word_chars / w, frac["symbol"], frac["upper"], frac["digit"], frac["bang"], frac["pipe"], frac["stop"], frac["comma"],
            frac["bracket"], T.count_by_row(data >= 0x80, offsets) / n_bytes, dup_lines / np.maximum(lines, 1), repeat / w, distinct / w, stops,
            short / np.maximum(lines, 1), n_words / np.maximum(lines, 1), caps, same,
        ], axis=1).astype(np.float32))
    if not base:
        return np.zeros((0, len(BASE)), np.int64), np.zeros((0, len(FEATURES)), np.float32)
    return np.concatenate(base), np.concatenate(feats)


def _table(members: list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[members] = True
    return out


def _distinct(words: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    if not len(words):
        return np.zeros(rows, np.int64)
    keys = words ^ T.mixed(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
    return np.bincount(row[order][fresh], minlength=rows)
