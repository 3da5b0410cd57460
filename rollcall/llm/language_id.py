"""Language identification by a bidirectional gated recurrent network over bytes.

Model: each direction reads one byte at a time, h' = h + z * (c - h) with gates z, r = step(W[byte] + U h)
and candidate c = bend(W[byte] + r * (U h)); ``step`` and ``bend`` are the piecewise linear sigmoid and
tanh, which cost a fraction of the smooth ones. Both states label every position; a document's
probabilities are the mean of its positions' probabilities. Trained in NumPy by backpropagation through
time with Adam, on the driver, from a bounded sample of rows: of each language the ``PER_LANGUAGE`` labelled documents
of at most ``LONGEST`` bytes (of a language without such, all its documents) least by hash of (doc_id, text). The whole text of each is
learned from, in stretches of ``STRETCH`` bytes in which state starts anew. That is the same at every size of the table: the hashes
of common languages are only compared with a bound before texts are read, and the bound is raised if it
proves too low. Rows equal in doc_id and text count once. The sample, its order and the initial weights
follow from hashes, so reruns agree. One row for each distinct label reaches the driver.

Whole texts are labelled: a text is read in windows of ``WINDOW`` bytes (state starts anew in each), all
windows of a slice of documents step together, longest first, so short ones cost nothing once they end;
long texts go in stretches of windows, so they cost no more memory than others.

A null text and a text without a letter get ``und`` with score 0, as does everything when nothing is
labelled; of classes with equal probability the first in code point order is predicted. lang, source and
doc_id are never read for a prediction. Repeated rows get equal predictions and scores that agree to
1e-6 (products of batches of different shape may round differently). An empty table gives no rows, and an
untrained network if it is the labelled one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, slices

#: Size of each direction's state; bytes of a window when labelling and of a stretch when training.
HIDDEN, WINDOW, STRETCH = 8, 256, 128
#: Labelled documents of a language that training sees at most, and their bytes; passes over them; stretches of a step; learning rate.
PER_LANGUAGE, LONGEST, EPOCHS, BATCH, RATE = 150, 1 << 16, 2, 128, 0.02
#: Windows that are labelled together.
WINDOWS = 4096
#: A document is held out when crc32(doc_id as text) % FOLDS is 0.
FOLDS = 5
UNKNOWN = "und"


class BiGRU:
    """Weights: table (2, 3h, 256), recur (2, 3h, h), out (2, classes, h), bias (classes). Gate rows: z, r, c."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.h = hidden
        self.w = {
            "table": rng.normal(0, 0.3, (2, 3 * hidden, 256)),
            "recur": rng.normal(0, 0.4 / np.sqrt(hidden), (2, 3 * hidden, hidden)),
            "out": rng.normal(0, 0.5, (2, len(classes), hidden)),
            "bias": np.zeros(len(classes)),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def gradient(self, x: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean loss of a batch and its gradient. x: bytes (steps, batch); real: positions that count; label: class of each column."""
        steps, n = x.shape
        h, w = self.h, self.w
        both = np.stack([x, x[::-1]])
        states = np.zeros((steps + 1, 2, h, n), np.float32)
        kept = []
        for t in range(steps):
            prev = states[t]
            a = np.stack([w["table"][d][:, both[d, t]] for d in range(2)])
            u = w["recur"] @ prev
            gate = a[:, : 2 * h] + u[:, : 2 * h] + np.float32(0.5)
            open_ = (gate > 0) & (gate < 1)
            gate = np.clip(gate, 0, 1)
            pre = a[:, 2 * h :] + gate[:, h:] * u[:, 2 * h :]
            cand = np.clip(pre, -1, 1)
            states[t + 1] = prev + gate[:, :h] * (cand - prev)
            kept.append((u[:, 2 * h :], gate, open_, cand, np.abs(pre) < 1))
        fwd, bwd = states[1:, 0], states[:0:-1, 1]
        logits = np.einsum("ch,thn->tcn", w["out"][0], fwd) + np.einsum("ch,thn->tcn", w["out"][1], bwd) + w["bias"][:, None]
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        weight = real / real.sum()
        loss = -float((np.log(p[:, label, np.arange(n)] + 1e-9) * weight).sum())
        p[:, label, np.arange(n)] -= 1
        p *= weight[:, None]
        g = {"bias": p.sum((0, 2)), "out": np.stack([np.einsum("tcn,thn->ch", p, fwd), np.einsum("tcn,thn->ch", p, bwd)])}
        dout = np.stack([np.einsum("ch,tcn->thn", w["out"][0], p), np.einsum("ch,tcn->thn", w["out"][1], p)[::-1]], 1)
        g["recur"] = np.zeros_like(w["recur"])
        da = np.zeros((steps, 2, 3 * h, n), np.float32)
        dh = np.zeros((2, h, n), np.float32)
        for t in range(steps - 1, -1, -1):
            uc, gate, open_, cand, bent = kept[t]
            prev, dh = states[t], dh + dout[t]
            z, r = gate[:, :h], gate[:, h:]
            dpre = dh * z * bent
            du = np.concatenate([dh * (cand - prev), dpre * uc], 1) * open_
            da[t] = np.concatenate([du, dpre], 1)
            du = np.concatenate([du, dpre * r], 1)
            g["recur"] += du @ prev.transpose(0, 2, 1)
            dh = dh * (1 - z) + w["recur"].transpose(0, 2, 1) @ du
        g["table"] = np.zeros_like(w["table"])
        for d in range(2):
            hot = np.zeros((256, steps * n), np.float32)
            hot[both[d].ravel(), np.arange(steps * n)] = 1
            g["table"][d] = da[:, d].transpose(1, 0, 2).reshape(3 * h, -1) @ hot.T
        return loss, g

    def fit(self, x: np.ndarray, size: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 2) -> list[float]:
        """Adam with a falling rate over shuffled batches. x: bytes (rows, STRETCH), of which the first size[row] are text."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        steps_in_all = epochs * -(-len(x) // batch)
        step, losses = 0, []
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), batch):
                rows = order[lo : lo + batch]
                real = (np.arange(x.shape[1])[:, None] < size[rows]).astype(np.float32)
                loss, g = self.gradient(x[rows].T, real, label[rows])
                losses.append(loss)
                norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
                step += 1
                now = rate * (1 - step / (steps_in_all + 1))
                for k in self.w:
                    q = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * q
                    v[k] = 0.99 * v[k] + 0.01 * q * q
                    self.w[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses

    def label(self, data: np.ndarray, off: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """Mean class probabilities over the positions of each text of a slice (texts, classes); zeros for an empty text.

        Windows are sorted by length, so those that have a position t are the first live[t] of them in
        both directions. States are kept row by row and one array for each gate, which is what NumPy
        gathers, multiplies and clips fastest.
        """
        k = len(self.classes)
        size = np.diff(off)
        parts = -(-size // window)
        text = np.repeat(np.arange(len(size)), parts)
        out = np.zeros((len(size), k))
        if not len(text):
            return out
        start = off[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
        length = np.minimum(window, off[1:][text] - start)
        for lo in range(0, len(text), WINDOWS):
            group = slice(lo, lo + WINDOWS)
            total = self._sums(data, start[group], length[group])
            for i in range(k):
                out[:, i] += np.bincount(text[group], total[i], len(size))
        return out / np.maximum(size, 1)[:, None]

    def _sums(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Class probabilities summed over the positions of each window (classes, windows)."""
        h, k = self.h, len(self.classes)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        n, steps = len(start), int(length[0])
        live = np.searchsorted(-length, -np.arange(steps), "left")
        scores = np.empty((2, steps, k, n), np.float32)
        for d in range(2):
            tables = [np.ascontiguousarray(self.w["table"][d, i * h : (i + 1) * h].T) for i in range(3)]
            tables[0] += np.float32(0.5)
            tables[1] += np.float32(0.5)
            recur = [np.ascontiguousarray(self.w["recur"][d, i * h : (i + 1) * h].T) for i in range(3)]
            state = np.zeros((n, h), np.float32)
            store = [np.empty((n, h), np.float32) for _ in range(4)]
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                m = live[t]
                now = state[:m]
                z, r, c, a = (x[:m] for x in store)
                byte = data[start[:m] + t].astype(np.intp)
                for gate, i in ((z, 0), (r, 1)):
                    np.matmul(now, recur[i], out=gate)
                    np.take(tables[i], byte, axis=0, out=a, mode="clip")
                    gate += a
                    np.clip(gate, 0, 1, out=gate)
                np.matmul(now, recur[2], out=c)
                c *= r
                np.take(tables[2], byte, axis=0, out=a, mode="clip")
                c += a
                np.clip(c, -1, 1, out=c)
                c -= now
                c *= z
                now += c
                np.matmul(self.w["out"][d], now.T, out=scores[d, t, :, :m])
        total = np.zeros((k, n), np.float32)
        for t in range(steps):
            p = scores[0, t, :, : live[t]]
            p += scores[1, t, :, : live[t]]
            p += self.w["bias"][:, None]
            p -= p.max(0)
            np.exp(p, out=p)
            p /= p.sum(0)
            total[:, : live[t]] += p
        out = np.empty_like(total)
        out[:, order] = total
        return out


def held_out(key):
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, text: str, lang: str, key: str, per_language: int) -> list[tuple[str, int, bytes]]:
    """(lang, hash, text) of the ``per_language`` labelled rows of each language outside the held-out fold that are least by hash."""
    own = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(held_out(F.col(key)), F.lit(False)))
    t = F.col(text).cast("string")
    rows = own.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h"), t.alias("t"), (F.octet_length(t) <= LONGEST).alias("short"))
    # one row for each class of the network
    counts = {r["lang"]: (r["n"], r["short"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("short").alias("short")).collect()}
    # the least by hash are within a bound that holds a few times as many; where it doesn't, it is raised
    size = {name: short or n for name, (n, short) in counts.items()}
    share = {name: min(1.0, 3 * per_language / n) for name, n in size.items()}
    whole = [name for name, (_, short) in counts.items() if not short]
    found: dict[str, list] = {}
    todo = set(counts)
    while todo:
        bounds = F.create_map(*(F.lit(x) for name in sorted(todo) for x in (name, int(share[name] * 2.0**64) - (1 << 63) if share[name] < 1 else (1 << 63) - 1)))
        near = rows.where((F.col("h") <= F.try_element_at(bounds, F.col("lang"))) & (F.col("short") | F.col("lang").isin(whole))).where(F.col("t").rlike(r"\p{L}"))
        got: dict[str, dict] = {name: {} for name in todo}
        for r in near.groupBy("lang", "h").agg(F.first("t").alias("t")).withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= per_language).collect():
            got[r["lang"]][r["h"]] = r["t"].encode()
        for name in sorted(todo):
            if len(got[name]) >= per_language or share[name] >= 1:
                found[name] = sorted(got[name].items())[:per_language]
                todo.remove(name)
            else:
                share[name] = min(1.0, 4 * share[name])
    return [(name, h, t) for name, kept in found.items() for h, t in kept]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE, epochs: int = EPOCHS) -> BiGRU | None:
    """The network, or None if nothing is labelled."""
    got = sorted(((h, name, k, t[k : k + STRETCH]) for name, h, t in training_rows(docs, text, lang, key, per_language) for k in range(0, len(t), STRETCH)), key=lambda r: r[:3])
    if not got:
        return None
    classes = sorted({r[1] for r in got})
    x = np.full((len(got), STRETCH), 32, np.uint8)
    for k, r in enumerate(got):
        x[k, : len(r[3])] = np.frombuffer(r[3], np.uint8)
    net = BiGRU(classes)
    net.fit(x, np.array([len(r[3]) for r in got]), np.array([classes.index(r[1]) for r in got]), epochs)
    return net


def identify(docs: DataFrame, net: BiGRU | None, text: str = "text", pred: str = "lang_pred", score_name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with columns ``pred`` and ``score_name`` (which replace any of these names).

    The text is all that a prediction reads. It goes to Python once, and comes back only if it is kept.
    """
    prepare(docs.sparkSession)
    names = [c for c in (docs.columns if keep is None else keep) if c not in (pred, score_name)]
    others = [c for c in names if c != text]
    kind = docs.schema[text].dataType.simpleString()
    back = text in names
    t = F.col(text).cast("string")
    own = F.struct(*others) if others else F.struct(F.lit(0).alias("x"))
    kept = docs.select(F.coalesce(t.rlike(r"\p{L}"), F.lit(False)).alias("_letters"), t.alias("_text"), own.alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "_text"):
                letters = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
                if net is None:
                    best, score = np.array([UNKNOWN] * len(letters), object), np.zeros(len(letters))
                else:
                    p = net.label(data, off)
                    best, score = np.array(net.classes, object)[p.argmax(1)], np.clip(p.max(1), 0, 1)
                best, score = np.where(letters, best, UNKNOWN), np.where(letters, score, 0.0)
                cols = [part.column(2), pa.array(best, pa.string()), pa.array(score)] + ([part.column(1)] if back else [])
                yield pa.RecordBatch.from_arrays(cols, names=["_row", "lang_pred", "score", "_text"][: len(cols)])

    row = kept.schema["_row"].dataType.simpleString()
    found = kept.mapInArrow(run, f"_row {row}, lang_pred string, score double{', _text string' if back else ''}")
    return found.select(*(F.col("_text").cast(kind).alias(c) if c == text else F.col("_row")[c].alias(c) for c in names), F.col("lang_pred").alias(pred), F.col("score").alias(score_name))
