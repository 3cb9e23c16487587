"""Quality classifier: a byte-level convolutional network in numpy.

Every second byte begins a window of four; a learned filter sums a weight for each of the four bytes, and one for
whether the window repeats another shortly before it.  Rectified responses are averaged over chunks of 256 bytes that
overlap by half and cover the whole document.  A second layer of filters reads each chunk; its responses are
max-pooled over all chunks and combined into one logit.  A document may thus be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches, slices, utf8
from tickforge.llm.sampling import held_out, per_class

FILTERS, HIDDEN, HALF, LAGS = 8, 8, 64, range(2, 26)
#: About this many training documents of each label, none of more than LONGEST characters.
EACH, LONGEST = 1000, 1 << 17


def windows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows laid out with gaps of zeros: both byte pairs of each window, the repeat flag, and each row's first window and count."""
    size = np.diff(off)
    room = size + 4 + (size & 1)
    start = np.concatenate([[0], np.cumsum(room)])
    pad = np.zeros(int(start[-1]) + 4, dtype=np.uint8)
    for s, a, b in zip(start.tolist(), off.tolist(), off[1:].tolist(), strict=False):
        pad[s : s + b - a] = data[a:b]
    even = pad.view(">u2").astype(np.uint32)
    odd = np.append(pad[1:-1].view(">u2").astype(np.uint32), np.zeros(2, np.uint32))
    n = int(start[-1]) // 2
    code, code_odd = even[:n] << np.uint32(16) | even[1 : n + 1], odd[:n] << np.uint32(16) | odd[1 : n + 1]
    again = np.zeros(n, dtype=bool)
    for lag in LAGS:
        shift, other = ((lag + 1) // 2, code_odd) if lag % 2 else (lag // 2, code)
        if shift < n:
            again[shift:] |= code[shift:] == other[: n - shift]
    first, count = start[:-1] // 2, (size + 1) // 2
    reach = max(LAGS) // 2 + 1
    head = (first[:, None] + np.arange(reach)).ravel()
    again[head[head < n]] = False
    return even[:n], even[1 : n + 1], again, np.stack([first, count], axis=1)


class ByteCnn:
    """Parameters and both passes; x is what windows() returns."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.3, (4, 256, FILTERS)), "c": r.normal(0, 0.3, FILTERS), "a": np.full(FILTERS, 0.1),
            "v": r.normal(0, 0.6, (HIDDEN, FILTERS)), "d": np.full(HIDDEN, 0.05), "w": r.normal(0, 0.5, HIDDEN), "b": np.zeros(1),
        }
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.shift, self.trained = 0.0, False

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of every byte pair at either half of a window."""
        e = self.p["e"]
        return tuple((e[k][:, None, :] + e[k + 1][None, :, :]).reshape(65536, FILTERS) for k in (0, 2))

    def chunks(self, x: tuple, tables: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Mean response of each chunk, the row it belongs to, and its first window and count of windows."""
        one, two, again, rows = x
        r = tables[0][one]
        r += tables[1][two]
        r += self.p["a"]
        r[again] += self.p["c"]
        np.maximum(r, 0, out=r)
        first, count = rows[:, 0], rows[:, 1]
        gap = np.ones(len(r), dtype=bool)
        live = np.zeros(len(r) + 1, dtype=np.int32)
        np.add.at(live, first, 1)
        np.add.at(live, first + count, -1)
        gap = np.cumsum(live[:-1]) == 0
        r[gap] = 0
        halves = (count + HALF - 1) // HALF
        of = np.repeat(np.arange(len(rows)), halves)
        k = np.arange(len(of)) - np.repeat(np.cumsum(halves) - halves, halves)
        at = first[of] + k * HALF
        if not len(at):
            return np.zeros((0, FILTERS), np.float32), of, at, at
        total = np.add.reduceat(r, at, axis=0)
        n = np.minimum(HALF, count[of] - k * HALF)
        pair = k + 1 < halves[of]  # this half and the next one make a chunk
        single = halves[of] == 1
        nxt = np.minimum(np.arange(len(of)) + 1, len(of) - 1)
        total = total + np.where(pair[:, None], total[nxt], 0)
        n = n + np.where(pair, n[nxt], 0)
        keep = pair | single
        return (total[keep] / n[keep, None]).astype(np.float32), of[keep], at[keep], n[keep]

    def forward(self, x: tuple, tables: tuple) -> tuple:
        h, of, at, n = self.chunks(x, tables)
        z = np.maximum(h @ self.p["v"].T + self.p["d"], 0)
        rows = len(x[3])
        top, which = np.zeros((rows, HIDDEN), z.dtype), np.full((rows, HIDDEN), -1)
        if len(of):
            begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            top[of[begin]] = np.maximum.reduceat(z, begin, axis=0)
            order = np.arange(len(of))[:, None]
            which[of[begin]] = np.maximum.reduceat(np.where(z == top[of], order, -1), begin, axis=0)
        return top @ self.p["w"] + self.p["b"][0], top, which, h, at, n

    def score(self, data: np.ndarray, off: np.ndarray, tables: tuple) -> np.ndarray:
        logit = self.forward(windows(data, off), tables)[0].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))

    def gradients(self, x: tuple, y: np.ndarray, tables: tuple) -> dict[str, np.ndarray]:
        logit, top, which, h, at, n = self.forward(x, tables)
        g = ((1 / (1 + np.exp(-np.clip(logit, -60, 60)))) - y) / len(y)
        out = {k: np.zeros_like(v) for k, v in self.p.items()}
        out["w"], out["b"][0] = g @ top, g.sum()
        dz = g[:, None] * self.p["w"] * (top > 0)
        row, unit = np.nonzero((top > 0) & (which >= 0))
        if not len(row):
            return out
        c, d = which[row, unit], dz[row, unit]
        np.add.at(out["v"], unit, d[:, None] * h[c])
        np.add.at(out["d"], unit, d)
        dh = np.zeros_like(h)
        np.add.at(dh, c, d[:, None] * self.p["v"][unit])
        used = np.unique(c)
        reps = n[used]
        pos = np.repeat(at[used], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        dr = np.repeat(dh[used] / reps[:, None], reps, axis=0)
        one, two, again = x[0][pos], x[1][pos], x[2][pos]
        live = tables[0][one] + tables[1][two] + self.p["a"] + again[:, None] * self.p["c"] > 0
        dr *= live
        out["a"], out["c"] = dr.sum(axis=0), dr[again].sum(axis=0)
        for k, b in enumerate((one >> 8, one & 255, two >> 8, two & 255)):
            for f in range(FILTERS):
                out["e"][k, :, f] = np.bincount(b, weights=dr[:, f], minlength=256)
        return out

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = 14, batch: int = 32, rate: float = 0.02, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                off = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])]).astype(np.int64)
                x = windows(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), off)
                g = self.gradients(x, y[pick], self.tables())
                t += 1
                step = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for k, v in self.p.items():
                    d = g[k] + 1e-5 * v
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.99 * s[k] + 0.01 * d * d
                    v -= (step * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", each: int = EACH) -> ByteCnn:
    """Fit on about `each` whole texts of either label that are not held out; the intercept is set to the labels' true ratio.

    Texts of more than LONGEST characters do not teach, and at most 4 * each texts do, where ids repeat.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).groupBy("i").agg(F.max("y").alias("y"))
    picked, counts = per_class(known, "y", ["i"], each)
    texts = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).where(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    taught = texts.join(F.broadcast(picked), "i").select("y", "i", "text").orderBy(F.xxhash64("i", "text"), "i").limit(4 * each)
    rows = sorted(((r["y"], r["i"], r["text"] or "") for r in taught.collect()), key=repr)
    model = ByteCnn()
    y = np.array([r[0] for r in rows], dtype=np.float32)
    model.trained = len(y) > 0
    if len(set(y.tolist())) == 2:
        model.fit([r[2].encode("utf-8") for r in rows], y)
        model.shift = float(np.log(counts[1] / counts[0]) - np.log((y == 1).sum() / (y == 0).sum()))
    elif len(y):
        model.p["w"][:] = 0
        model.p["b"][0] = 4.0 if y[0] == 1 else -4.0
    return model


def score(df: DataFrame, model: ByteCnn, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with score of every whole text."""
    source = text_col if text_col in keep else "_text"  # a text that is kept anyway goes to Python once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables()
        for batch in batches:
            for part in slices(batch, source, 1 << 19):
                s = model.score(*utf8(part.column(source)), tables)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(s, pa.float64())], [*keep, "score"])

    schema = ", ".join(f"`{c}` {k}" for c, k in df.select(*keep).dtypes)
    own = [] if source in keep else [F.col(text_col).alias(source)]
    return map_batches(df.select(*keep, *own), run, f"{schema}, score double")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", each: int = EACH) -> DataFrame:
    """Return (id, held_out, score, predicted) of every row, learnt from labelled rows that are not held out.

    Nulls: a null text is scored as the empty one, whose score is the model's for no chunk; labels other than 0 and 1
    teach nothing; a null id is hashed as the empty string.  With one label only, every score leans to it; with none
    the model is untrained.  Repeated rows give equal rows (repeated labels of an id count once, the larger); empty
    tables give empty ones; other columns are ignored, whatever their names.
    """
    model = train(df, labels, id_col, text_col, label_col, each)
    rows = df.select(F.col(id_col).alias(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("_t"))
    return score(rows, model, "_t", (id_col, "held_out")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
