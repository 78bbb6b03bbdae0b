"""Toxicity: a bidirectional gated recurrent network over overlapping windows of words.

A word enters as the sum of its own hashed embedding and the mean embedding of its character
trigrams (with its borders). Each window of WINDOW words, one every STRIDE words, runs through
one gated recurrent layer in either direction; attention pools the states, a linear layer gives
the window's logit, and a text's score is that of its highest window. Windows overlap by half:
every word is read, those more than STRIDE words from both ends of a text twice, and any passage of at
most WINDOW - STRIDE + 1 words lies whole in a window; a longer one may be cut. The network is trained in numpy, with hand-written back-propagation, on at
most SAMPLE labelled rows, half of either label.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import labelled_sample
from .textbatch import LOWER, cut, hash_spans, mix, slices, text_column, words

WINDOW, STRIDE = 32, 16
WORDS, GRAMS, EMBED, HIDDEN = 1 << 15, 1 << 14, 8, 8
SAMPLE = 4000
EPOCHS = 4
#: Text bytes of one update, and the least number of updates, whatever the sample's size.
STEP_BYTES, UPDATES = 24 << 10, 400
_SLICE = 2 << 20
_BATCH = 2048
_G = np.uint64(0x9E3779B97F4A7C15)
_EDGE = np.zeros(256, dtype=bool)
_EDGE[[ord(c) for c in ".,;:!?()[]{}<>\"'*_-"]] = True


def read_words(chunk: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a padded chunk and where they stand.

    Returns the word slot of each distinct word, its trigram slots one after the other with their
    borders, the distinct word at each place, and each document's first place.
    """
    chunk = LOWER[chunk]
    starts, ends, first = words(chunk, offs)
    for _ in range(3):  # punctuation at the ends doesn't make another word
        wide = ends - starts > 1
        ends = ends - (wide & _EDGE[chunk[ends - 1]])
        wide = ends - starts > 1
        starts = starts + (wide & _EDGE[chunk[starts]])
    key, at, place = np.unique(hash_spans(chunk, starts, ends, 9), return_index=True, return_inverse=True)
    s, e = starts[at], ends[at]
    size = e - s
    borders = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(s - borders[:-1], size) + np.arange(borders[-1])
    mid = chunk[where].astype(np.uint64)
    left = np.where(where == np.repeat(s, size), 1, chunk[np.maximum(where - 1, 0)]).astype(np.uint64)
    right = np.where(where == np.repeat(e, size) - 1, 1, chunk[where + 1]).astype(np.uint64)
    gram = mix((left << np.uint64(16) | mid << np.uint64(8) | right) * _G) % np.uint64(GRAMS)
    return (key % np.uint64(WORDS)).astype(np.int64), gram.astype(np.int64), borders, place, first


def window_places(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, WINDOW) places, how many of them are real, and the document of each window."""
    n = np.diff(first)
    per = np.maximum(1, -(-np.maximum(n - (WINDOW - STRIDE), 0) // STRIDE))
    doc = np.repeat(np.arange(len(n)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[doc] + nth * STRIDE
    real = np.minimum(WINDOW, first[doc + 1] - begin)
    return begin[:, None] + np.minimum(np.arange(WINDOW), np.maximum(real[:, None] - 1, 0)), real, doc


def _summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indexes in order and the sum of their rows."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    lead = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[lead], np.add.reduceat(rows[order], lead, axis=0)


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward pass and training of the recurrent network."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        f = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        self.p = {"word": f(WORDS, EMBED, scale=0.05), "gram": f(GRAMS, EMBED, scale=0.3),
                  "att": f(2 * HIDDEN, scale=0.1), "out": f(2 * HIDDEN, scale=0.3), "bias": np.full(1, -1.0, np.float32)}
        for d in "fb":
            self.p |= {"w" + d: f(EMBED, 3 * HIDDEN, scale=0.4), "u" + d: f(HIDDEN, 3 * HIDDEN, scale=0.3), "c" + d: np.zeros(3 * HIDDEN, np.float32)}
        self.sq = {k: np.full_like(v, 1e-4) for k, v in self.p.items()}

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Network:
        net = cls.__new__(cls)
        net.p = dict(np.load(io.BytesIO(raw)))
        return net

    def inputs(self, slot: np.ndarray, gram: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """The input vector of each distinct word."""
        x = self.p["word"][slot]
        if len(gram):
            x = x + np.add.reduceat(self.p["gram"][gram], borders[:-1], axis=0) / np.diff(borders)[:, None]
        return x.astype(np.float32)

    def _run(self, d: str, proj: np.ndarray, places: np.ndarray, live: np.ndarray, keep: list | None) -> np.ndarray:
        """States (WINDOW, windows, HIDDEN) of one direction; ``keep`` collects what the way back needs."""
        h = np.zeros((len(places), HIDDEN), dtype=np.float32)
        out = np.empty((WINDOW, *h.shape), dtype=np.float32)
        u = self.p["u" + d]
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            a = np.take(proj, places[:, t], axis=0)
            b = h @ u
            gates = _sig(a[:, :2 * HIDDEN] + b[:, :2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(a[:, 2 * HIDDEN:] + r * b[:, 2 * HIDDEN:])
            step = (new + z * (h - new)) * live[t] + h * (1 - live[t])
            if keep is not None:
                keep.append((t, h, z, r, new, b[:, 2 * HIDDEN:]))
            out[t] = h = step
        return out

    def forward(self, x: np.ndarray, places: np.ndarray, real: np.ndarray, tape: dict | None = None, proj: dict | None = None) -> np.ndarray:
        """The logit of each window."""
        live = (np.arange(WINDOW)[:, None] < real).astype(np.float32)[:, :, None]
        keep: dict = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
        proj = proj or {d: x @ self.p["w" + d] + self.p["c" + d] for d in "fb"}
        h = np.concatenate([self._run(d, proj[d], places, live, keep[d]) for d in "fb"], axis=2)
        e = h @ self.p["att"] + (live[:, :, 0] - 1) * 1e4
        alpha = np.exp(e - e.max(axis=0))
        alpha = alpha / alpha.sum(axis=0) * live[:, :, 0]
        pooled = (alpha[:, :, None] * h).sum(axis=0)
        if tape is not None:
            tape.update(live=live, h=h, alpha=alpha, pooled=pooled, keep=keep)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, x: np.ndarray, places: np.ndarray, tape: dict, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the dense parameters and of the distinct words' inputs."""
        h, alpha, live = tape["h"], tape["alpha"], tape["live"]
        g = {"out": tape["pooled"].T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
        dpool = dlogit[:, None] * self.p["out"]
        dalpha = (h * dpool).sum(axis=2)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["att"] = np.einsum("twk,tw->k", h, de)
        dh_all = alpha[:, :, None] * dpool + de[:, :, None] * self.p["att"]
        dx = np.zeros_like(x)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            u = self.p["u" + d]
            du = np.zeros_like(u)
            back = np.empty((WINDOW, len(places), 3 * HIDDEN), dtype=np.float32)
            dh = np.zeros((len(places), HIDDEN), dtype=np.float32)
            for t, before, z, r, new, ub in reversed(tape["keep"][d]):
                dh = dh + dh_all[t][:, part]
                on = live[t]
                dstep = dh * on
                dnew = dstep * (1 - z) * (1 - new * new)
                dz = dstep * (before - new) * z * (1 - z)
                dr = dnew * ub * r * (1 - r)
                back[t] = np.concatenate([dz, dr, dnew], axis=1)
                db = np.concatenate([dz, dr, dnew * r], axis=1)
                du += before.T @ db
                dh = dstep * z + db @ u.T + dh * (1 - on)
            dproj = np.zeros((len(x), 3 * HIDDEN), dtype=np.float32)
            at, rows = _summed(places.T.ravel(), back.reshape(-1, 3 * HIDDEN))
            dproj[at] = rows
            g["u" + d], g["w" + d], g["c" + d] = du, x.T @ dproj, dproj.sum(axis=0)
            dx += dproj @ self.p["w" + d].T
        return g, dx

    def _move(self, name: str, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        at = slice(None) if rows is None else rows
        self.sq[name][at] += grad * grad
        self.p[name][at] -= rate * grad / np.sqrt(self.sq[name][at])

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adagrad on batches of whole documents; a document's gradient goes to its highest windows."""
        order = np.random.default_rng(4)
        steps = max(1, sum(len(t) + 64 for t in texts) // STEP_BYTES)
        for _ in range(max(epochs, -(-UPDATES // steps))):
            perm = order.permutation(len(texts))
            sizes = np.cumsum([len(texts[i]) + 64 for i in perm])
            for part in np.split(perm, np.flatnonzero(np.diff(sizes // STEP_BYTES)) + 1):
                raw = [texts[i] for i in part]
                offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
                slot, gram, borders, place, first = read_words(*cut(np.frombuffer(b"".join(raw), np.uint8), offs, 0, len(raw)))
                if not len(slot):
                    continue
                x = self.inputs(slot, gram, borders)
                where, real, doc = window_places(first)
                where = place[np.minimum(where, len(place) - 1)]
                tape: dict = {}
                logit = self.forward(x, where, real, tape)
                top = np.full(len(raw), -np.inf)
                np.maximum.at(top, doc, logit)
                share = np.exp(2 * (logit - top[doc]))
                share /= np.bincount(doc, weights=share, minlength=len(raw))[doc]
                dlogit = ((_sig(top) - labels[part])[doc] * share).astype(np.float32)
                g, dx = self.backward(x, where, tape, dlogit)
                for name, grad in g.items():
                    self._move(name, np.clip(grad, -5, 5), 0.03)
                for name, at, grad in (("word", slot, dx), ("gram", gram, np.repeat(dx / np.diff(borders)[:, None], np.diff(borders), axis=0))):
                    rows, total = _summed(at, grad)
                    self._move(name, total, 0.05, rows)

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The score of each text: its highest window's."""
        out = np.full(len(offs) - 1, -np.inf)
        for i, j in slices(offs, _SLICE):
            slot, gram, borders, place, first = read_words(*cut(buf, offs, i, j))
            where, real, doc = window_places(first)
            x = self.inputs(slot, gram, borders) if len(slot) else np.zeros((1, EMBED), np.float32)
            where = place[np.minimum(where, len(place) - 1)] if len(place) else np.zeros_like(where)
            proj = {d: x @ self.p["w" + d] + self.p["c" + d] for d in "fb"}
            for k in range(0, len(doc), _BATCH):
                at = slice(k, k + _BATCH)
                np.maximum.at(out, i + doc[at], self.forward(x, where[at], real[at], proj=proj))
        return _sig(np.clip(out, -35, 35))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> bytes:
    """Fits the network in one task on at most ``sample`` labelled rows, up to half of either label.

    The intercept then moves by the difference in log odds between all labelled rows and the sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        marks: list[int] = []
        for batch in batches:
            texts += [t.encode() for t in batch.column(0).to_pylist()]
            marks += batch.column(1).to_pylist()
        net = Network()
        net.fit(texts, np.array(marks, dtype=np.float64))
        if 0 < sum(marks) < len(marks):
            net.p["bias"] += np.float32(odds - np.log(sum(marks) / (len(marks) - sum(marks))))
        yield pa.RecordBatch.from_arrays([pa.array([net.dump()], pa.binary())], names=["net"])

    share = labels.where(F.col(label_col).isin(0, 1)).agg(F.sum(label_col), F.count("*")).first()
    odds = float(np.log((share[0] or 0) + 0.5) - np.log(share[1] - (share[0] or 0) + 0.5))
    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col, balanced=True)
    got = (rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "label").mapInArrow(run, "net binary").first())
    return got["net"] if got else Network().dump()


def score(docs: DataFrame, net: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` in 0..1, from every window of every whole text.

    Null and empty texts score one empty window; all rows and columns stay (one named
    ``score_col`` is replaced); an empty table gives an empty result.
    """
    docs = docs.drop(score_col)
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of parameters, about 1.6 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.load(held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(*text_column(batch.column(at))))],
                                             names=[*batch.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")
