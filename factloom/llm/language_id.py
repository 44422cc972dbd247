"""Language identification by a byte convolutional network trained in numpy.

A text is cut into windows of ``WINDOW`` bytes. Filters of several widths run over the bytes' embeddings, each keeps its
largest value in the window, and a softmax over those values gives the window's language; a text takes the mean over all
its windows. For scoring, embedding and filters are multiplied out into one table for each byte or pair of bytes, so a
window costs a few table look-ups and additions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from factloom.llm import texts as T
from factloom.llm.runtime import ensure_importable, free

WINDOW = 96
WIDTHS = (2, 3, 4)
UNKNOWN = "und"
_FOLD = T.LOWER.copy()
_FOLD[0x30:0x3A] = 0x30


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with letters of ASCII and of the Latin-1 block in lower case, and every digit a zero."""
    out = _FOLD[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all rows (the last of a row is filled with zeros) and their rows."""
    n = -(-np.diff(offsets) // WINDOW)
    row = np.repeat(np.arange(len(n)), n)
    start = offsets[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][row][:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8), row


@dataclass
class ByteConvNet:
    classes: list[str]
    embed: np.ndarray  # 256 x d
    filters: list[np.ndarray]  # for each width: width x d x f
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> ByteConvNet:
        """Responses of pairs and of single bytes, in place of embedding and filters."""
        self._tables = []
        for w, k in zip(WIDTHS, self.filters):
            single = [(self.embed @ k[j]).astype(np.float32) for j in range(w)]
            parts = [((single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, -1), j, True) for j in range(0, w - 1, 2)]
            self._tables.append(parts + ([(single[w - 1], w - 1, False)] if w % 2 else []))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of windows."""
        if not hasattr(self, "_tables"):
            self.tables()
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w, parts, b in zip(WIDTHS, self._tables, self.bias):
            p = WINDOW - w + 1
            r = None
            for table, j, two in parts:
                got = table.take(pair[:, j : j + p] if two else x[:, j : j + p], axis=0)
                r = got if r is None else np.add(r, got, out=r)
            pooled.append(np.maximum(r.max(axis=1) + b, 0))
        z = np.concatenate(pooled, axis=1) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, classes: list[str], d: int = 8, f: int = 16, epochs: int = 6, steps: int = 300, batch: int = 128, rate: float = 4e-3, seed: int = 5) -> ByteConvNet:
    """Adam on the cross-entropy of windows; the gradient flows through each filter's largest response.

    At least ``epochs`` passes and ``steps`` steps are made, so that a small sample is learnt as well.
    """
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, d))]
    params += [rng.normal(0, 1 / np.sqrt(w * d), (w * d, f)) for w in WIDTHS] + [np.zeros(f) for _ in WIDTHS]
    params += [rng.normal(0, 0.1, (f * len(WIDTHS), len(classes))), np.zeros(len(classes))]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    nw, step = len(WIDTHS), 0
    for _ in range(max(epochs, -(-steps * batch // max(len(x), 1)))):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            xb, yb = x[order[lo : lo + batch]].astype(np.int64), y[order[lo : lo + batch]]
            n = len(xb)
            e = params[0][xb]
            pooled, where = [], []
            for k, w in enumerate(WIDTHS):
                p = WINDOW - w + 1
                u = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, p, w * d)
                r = u @ params[1 + k] + params[1 + nw + k]
                at = r.argmax(axis=1)
                pooled.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
                where.append(at)
            hidden = np.concatenate(pooled, axis=1)
            a = np.maximum(hidden, 0)
            z = a @ params[-2] + params[-1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(n), yb] -= 1
            g /= n
            grads = [np.zeros_like(params[0])] + [None] * (2 * nw) + [a.T @ g, g.sum(axis=0)]
            back = (g @ params[-2].T) * (hidden > 0)
            for k, w in enumerate(WIDTHS):
                gk = back[:, k * f : (k + 1) * f]
                bytes_ = xb[np.arange(n)[:, None, None], where[k][:, :, None] + np.arange(w)]  # n, f, w
                grads[1 + k] = np.einsum("nf,nfk->kf", gk, params[0][bytes_].reshape(n, f, w * d))
                grads[1 + nw + k] = gk.sum(axis=0)
                de = gk[:, :, None, None] * params[1 + k].T.reshape(f, w, d)[None]
                np.add.at(grads[0], bytes_.ravel(), de.reshape(-1, d))
            step += 1
            for k, gr in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                params[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    filters = [params[1 + k].reshape(w, d, f).astype(np.float32) for k, w in enumerate(WIDTHS)]
    return ByteConvNet(classes, params[0].astype(np.float32), filters, [b.astype(np.float32) for b in params[1 + nw : 1 + 2 * nw]], params[-2].astype(np.float32), params[-1].astype(np.float32))


def held_out(id_col: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text leaves 2 when divided by four; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts_per_lang: int = 600, windows_per_text: int = 6, max_langs: int = 100) -> ByteConvNet | None:
    """Train on a bounded sample: of the ``max_langs`` most frequent languages the ``texts_per_lang`` ids with the least hash, a
    text for each of them (the one with the least hash), and up to ``windows_per_text`` evenly spaced windows of each.
    Held-out rows and null languages are left out. None without labels.
    """
    ensure_importable(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where(~held_out("_id") & F.col("_id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("t") > 0))

    def some(batches):
        for batch in batches:
            texts, langs, order = [], [], []
            for text, lang, key in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = -(-len(text) // WINDOW)
                for k in sorted({i * n // windows_per_text for i in range(windows_per_text)}):
                    texts.append(text[k * WINDOW : (k + 1) * WINDOW])
                    langs.append(lang)
                    order.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(langs, pa.string()), pa.array(order, pa.int64())], ["w", "lang", "key"])

    # Ids first, as rows without texts. By a language's number of ids, only keys that may be among its first are ranked, so
    # the ranking sees a few rows for each text of the sample at any size. The texts of the chosen ids are read afterwards.
    ids = rows.select("_id", F.xxhash64(F.lit(3), "_id").alias("key"), "lang")
    counts = ids.groupBy("lang").agg(F.approx_count_distinct("_id").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    may = F.lit(False)
    for lang, n in counts:
        share = min(1.0, (3 * texts_per_lang + 200) / n)
        may = may | ((F.col("lang") == lang) & (F.col("key") <= min(int(-(2**63) + share * 2**64), 2**63 - 1)))
    first = ids.where(may).distinct().withColumn("_r", F.row_number().over(W.partitionBy("lang").orderBy("key", "_id"))).where(F.col("_r") <= texts_per_lang)
    picked = first.select("_id", "lang").collect()  # texts_per_lang * max_langs at most
    if not picked:
        return None
    langs = sorted({r.lang for r in picked})
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, first.select("_id", "lang").schema))
    texts = rows.join(chosen, ["_id", "lang"]).groupBy("_id", "lang").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    sample = texts.select("t", "lang", F.xxhash64("_id").alias("key")).mapInArrow(some, "w binary, lang string, key long")
    got = sorted(map(tuple, sample.distinct().collect()), key=lambda r: (r[1], r[2], bytes(r[0])))
    data = folded(np.frombuffer(b"".join(bytes(r[0]).ljust(WINDOW, b"\0") for r in got), np.uint8)).reshape(-1, WINDOW)
    # A fifth of the windows is cut short, as those of short texts are.
    rng = np.random.default_rng(11)
    ends = np.where(rng.random(len(data)) < 0.2, rng.integers(6, WINDOW, len(data)), WINDOW)
    data = np.where(np.arange(WINDOW) < ends[:, None], data, 0).astype(np.uint8)
    y = np.array([langs.index(r[1]) for r in got])
    return train(data, y, langs)


def identify(docs: DataFrame, model: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """docs with lang_pred string and score double (0 to 1), from the text alone.

    A null text, and one without letters, is ``und`` with score 0; so is every text without a model (no labelled rows).
    Columns of those two names are replaced, all others stay whatever their names.
    """
    spark = docs.sparkSession
    ensure_importable(spark)
    shared = spark.sparkContext.broadcast(model)  # a few hundred KB; the tables are made on the executors

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(text: pa.Array) -> pa.Array:
        net = shared.value
        letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        best, score = np.zeros(len(text), np.int64), np.zeros(len(text))
        if net is not None and len(net.classes):
            data, offsets = T.flat(text)
            for lo, hi in T.blocks(offsets, 1 << 17):
                off = offsets[lo : hi + 1] - offsets[lo]
                block = folded(data[offsets[lo] : offsets[hi]])
                x, row = windows(block, off)
                total = np.zeros((hi - lo, len(net.classes)))
                for k in range(0, len(x), 1024):
                    p = net.predict(x[k : k + 1024])
                    rows, at = np.unique(row[k : k + 1024], return_index=True)
                    total[rows] += np.add.reduceat(p, at, axis=0)
                mean = total / np.maximum(np.bincount(row, minlength=hi - lo), 1)[:, None]
                best[lo:hi], score[lo:hi] = mean.argmax(axis=1), mean.max(axis=1)
        known = letters & (net is not None)
        langs = pa.array(net.classes if net is not None and net.classes else [UNKNOWN], pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays([pc.if_else(pa.array(known), langs, UNKNOWN), pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], ["lang", "score"])

    (own,) = free(docs, "_predicted")
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.withColumn(own, predicted(F.col(f"`{text_col}`")))
    return out.select(*[F.col(f"`{c}`") for c in names], F.col(f"{own}.lang").alias("lang_pred"), F.col(f"{own}.score").alias("score"))
