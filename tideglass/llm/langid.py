"""Language identification by a byte convolutional network (operator 8).

Byte embeddings, filters of several widths, max pooling over a window and a softmax layer, trained
in numpy on the driver on a bounded sample of labelled documents: the TRAIN_DOCS documents of each
language whose id hashes lowest, at most TRAIN_WINDOWS windows from each. The trained network is
a few tables: the sum that a filter takes over its bytes is looked up by byte pairs. Every text
is cut into windows of WINDOW bytes from its first to its last byte, and the mean of its windows'
class probabilities, weighted by their bytes, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideglass.llm import texts
from tideglass.llm.mixing import id_hash
from tideglass.sources.workspace import stage

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
TRAIN_DOCS = 400
TRAIN_WINDOWS = 6
EPOCHS = 6
BATCH = 64
AT_ONCE = 96  # windows of one lookup
UNDETERMINED = "und"

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def held_out(doc_id: Column) -> Column:
    """Documents that are never trained on: crc32 of the id as text, modulo 4, is 2."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def cut_windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, bytes in each, text of each); the last window of a text is padded with 0."""
    size = np.diff(bounds)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[:-1][owner] + nth * WINDOW
    length = np.minimum(WINDOW, bounds[1:][owner] - start)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start].copy() \
        if len(start) else np.zeros((0, WINDOW), np.uint8)
    out[np.arange(WINDOW) >= length[:, None]] = 0
    return out, length, owner


@dataclass
class Network:
    """Labels, the pair and byte tables of the filters, and the last layer."""

    labels: list[str]
    pairs: np.ndarray   # (65536, 3 * FILTERS): the first two bytes of the filters of each width
    third: np.ndarray   # (256, FILTERS): the third byte of width 3
    later: np.ndarray   # (65536, FILTERS): bytes three and four of width 4
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        n, f = len(windows), FILTERS
        pair = windows[:, :-1].astype(np.int32) << 8
        pair |= windows[:, 1:]
        first = np.take(self.pairs, pair, axis=0)
        top = [first[:, :, :f].max(axis=1)]
        top.append((first[:, :-1, f:2 * f] + np.take(self.third, windows[:, 2:], axis=0)).max(axis=1))
        top.append((first[:, :-2, 2 * f:] + np.take(self.later, pair[:, 2:], axis=0)).max(axis=1))
        return np.maximum(np.concatenate(top, axis=1).reshape(n, -1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        logits = np.concatenate([
            self.pooled(windows[k:k + AT_ONCE]) @ self.out + self.out_bias
            for k in range(0, len(windows), AT_ONCE)])
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)


def _columns(embedded: np.ndarray, width: int) -> np.ndarray:
    """(windows, positions, width * EMBEDDING) of neighbouring embeddings."""
    n = embedded.shape[1] - width + 1
    return np.concatenate([embedded[:, k:k + n] for k in range(width)], axis=2)


def train(windows: np.ndarray, length: np.ndarray, target: np.ndarray, labels: list[str],
          epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Adam on the cross entropy. Half of the windows are cut short at random each epoch, so that
    short texts are learnt as well."""
    rng = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    p = {"emb": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS))
    p |= {"bias": np.zeros(total), "out": rng.normal(0, total ** -0.5, (total, len(labels))),
          "out_bias": np.zeros(len(labels))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            x, n = windows[pick].copy(), len(pick)
            keep = np.where(rng.random(n) < 0.5, length[pick],
                            np.exp(rng.uniform(np.log(8), np.log(WINDOW), n)).astype(int))
            x[np.arange(WINDOW) >= keep[:, None]] = 0
            g = _gradients(p, x, target[pick])
            step += 1
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v2[k] += 0.001 * (g[k] ** 2 - v2[k])
                p[k] -= 0.004 * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return _tables(p, labels)


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    n, rows = len(x), np.arange(len(x))[:, None]
    embedded = p["emb"][x]
    tops, where = [], {}
    for w in WIDTHS:
        value = _columns(embedded, w) @ p[f"w{w}"]
        where[w] = value.argmax(axis=1)
        tops.append(np.take_along_axis(value, where[w][:, None, :], axis=1)[:, 0])
    pre = np.concatenate(tops, axis=1) + p["bias"]
    hidden = np.maximum(pre, 0)
    logits = hidden @ p["out"] + p["out_bias"]
    prob = np.exp(logits - logits.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    prob[np.arange(n), target] -= 1
    prob /= n
    back = (prob @ p["out"].T) * (pre > 0)
    g = {"out": hidden.T @ prob, "out_bias": prob.sum(axis=0), "bias": back.sum(axis=0),
         "emb": np.zeros_like(p["emb"])}
    for k, w in enumerate(WIDTHS):
        d = back[:, k * FILTERS:(k + 1) * FILTERS]
        gw = np.zeros_like(p[f"w{w}"]).reshape(w, EMBEDDING, FILTERS)
        for o in range(w):
            at = x[rows, where[w] + o]                       # (windows, filters): the byte there
            gw[o] = np.einsum("nfe,nf->ef", p["emb"][at], d)
            up = d[:, :, None] * p[f"w{w}"].reshape(w, EMBEDDING, FILTERS)[o].T[None]
            np.add.at(g["emb"], at.ravel(), up.reshape(-1, EMBEDDING))
        g[f"w{w}"] = gw.reshape(w * EMBEDDING, FILTERS)
    return {k: v.astype(np.float32) for k, v in g.items()}


def _tables(p: dict[str, np.ndarray], labels: list[str]) -> Network:
    by = {(w, o): p["emb"] @ p[f"w{w}"][o * EMBEDDING:(o + 1) * EMBEDDING]
          for w in WIDTHS for o in range(w)}

    def pair(w: int, o: int) -> np.ndarray:
        return (by[w, o][:, None] + by[w, o + 1][None]).reshape(65536, FILTERS)

    return Network(labels, np.ascontiguousarray(np.concatenate([pair(w, 0) for w in WIDTHS], axis=1)),
                   by[3, 2], pair(4, 2), p["bias"], p["out"], p["out_bias"])


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text at most TRAIN_WINDOWS windows, evenly spread."""
    for part in texts.slices(batches, 2):
        data, bounds = texts.utf8(part.column(2))
        windows, length, owner = cut_windows(data, bounds)
        first = np.searchsorted(owner, np.arange(part.num_rows))
        count = np.bincount(owner, minlength=part.num_rows)
        picks = [f + np.unique(np.linspace(0, c - 1, min(c, TRAIN_WINDOWS)).astype(int))
                 for f, c in zip(first, count) if c]
        at = np.concatenate(picks) if picks else np.zeros(0, int)
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(owner[at])), part.column(1).take(pa.array(owner[at])),
             pa.array([w.tobytes() for w in windows[at]], pa.binary()),
             pa.array(length[at], pa.int64())], ["key", "lang", "window", "length"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Network | None:
    """The network trained on documents that are not held out and have a language; None if there
    are none. The driver gets TRAIN_DOCS * TRAIN_WINDOWS windows a language at most."""
    keys = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("picked"), F.col(lang_col).alias("of"),
        id_hash(F.col(id_col)).alias("order"))
    lowest = Window.partitionBy("of").orderBy("order", "picked")
    picked = stage(keys.withColumn("rank", F.row_number().over(lowest))
                   .where(F.col("rank") <= TRAIN_DOCS).select("picked", "of", "order").distinct(),
                   "langid-sample")
    chosen = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                         F.col(text_col).alias("text")).join(
        picked, F.col("id").eqNullSafe(F.col("picked")) & (F.col("lang") == F.col("of")))
    rows = chosen.select(F.col("order").alias("key"), "lang", "text").mapInArrow(
        _sample_windows, "key long, lang string, window binary, length long").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.key, bytes(r.window)))
    labels = sorted({r.lang for r in rows})
    return train(np.frombuffer(b"".join(bytes(r.window) for r in rows), np.uint8).reshape(-1, WINDOW),
                 np.array([r.length for r in rows]),
                 np.array([labels.index(r.lang) for r in rows]), labels)


def _letters(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    def any_in(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[bounds[1:]] > total[bounds[:-1]]

    out = any_in(_ASCII_LETTER[data])
    for k in np.flatnonzero(~out & any_in(data >= 128)):
        out[k] = any(c.isalpha() for c in data[bounds[k]:bounds[k + 1]].tobytes().decode())
    return out


def predict(network: Network | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of an Arrow column."""
    data, bounds = texts.utf8(column)
    n = len(bounds) - 1
    score, lang = np.zeros(n), [UNDETERMINED] * n
    windows, length, owner = cut_windows(data, bounds)
    if network is None or not len(windows):
        return lang, score
    total = np.zeros((n, len(network.labels)))
    np.add.at(total, owner, network.probabilities(windows) * length[:, None])
    mean = total / np.maximum(np.diff(bounds), 1)[:, None]
    for k in np.flatnonzero(_letters(data, bounds)):
        best = int(mean[k].argmax())
        lang[k], score[k] = network.labels[best], min(1.0, float(mean[k, best]))
    return lang, score


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", network: Network | None = None) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score (0 to 1).

    ``network`` is trained on ``docs`` unless given. NULL texts, empty texts and texts without a
    letter are ``und`` with score 0, as is everything if no document has a language. A NULL id
    counts as the empty text for ``held_out``. Repeated rows are predicted each. Language, source
    and id are not looked at for a prediction. Other columns of ``docs`` play no part.
    """
    model = docs.sparkSession.sparkContext.broadcast(
        network or fit(docs, id_col, text_col, lang_col))  # fixed size, about 17 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, 2):
            lang, score = predict(model.value, part.column(2))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        F.col(text_col).alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = 0.3, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a language, by a score of ``min_score`` or more."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col))
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, position):
            lang, score = predict(model.value, part.column(position))
            ok = (np.array(lang, dtype=object) != UNDETERMINED) & (score >= min_score)
            yield part.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
