"""Language identification in two steps: a family first, then one-versus-one linear SVMs within it.

Texts are hashed byte trigrams with letters lower-cased and all else as spaces; each vector holds square roots of
relative counts, so its length is 1.  Families are the languages whose mean vectors are most alike, merged by average
linkage until ceil(sqrt(languages)) are left.  All classifiers are linear SVMs with squared hinge loss.

The SVMs only tell learned languages apart; of two families one always wins.  Whether a text is in any of them is told
by the mean log density of its trigrams under the learned languages, held against what learned rows have.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches, slices, utf8
from tickforge.llm.sampling import held_out, per_class

CELLS = 4096
#: Rows whose dense vectors are in memory at once.
VECTORS = 256
#: Most training rows in all; they are shared out equally among the languages.
MOST_TRAIN = 1600
#: Most languages that are learnt, the most frequent ones; each has MOST_TRAIN / MOST_LANGUAGES rows at least.
MOST_LANGUAGES = 200
#: With fewer learned rows than this no text is strange.
LEAST_LEARNT = 40
#: A text is strange beyond this many times the 99 % quantile of learned rows' deviations.
BEYOND = 4.0

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_vectors(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One unit vector of CELLS hashed trigrams for each row; rows without one are zero."""
    rows = len(off) - 1
    b = _FOLD[data]
    if len(b) > 1:
        upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
        b[upper] += 32
    if len(b) < 3:
        return np.zeros((rows, CELLS), np.float32)
    x = b.astype(np.uint32)
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    cell = (code * np.uint32(2654435761)) >> np.uint32(20)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(off))[:-2]
    keep = code != 0x202020
    for back in (1, 2):
        ends = off[1:] - back
        ends = ends[(ends >= 0) & (ends < len(keep))]
        keep[ends] = False
    n = np.bincount(row[keep] * CELLS + cell[keep], minlength=rows * CELLS).reshape(rows, CELLS)
    total = n.sum(axis=1, keepdims=True)
    return np.sqrt(n.astype(np.float32) / np.maximum(total, 1).astype(np.float32))


def linear_svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 250) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM (squared hinge, classes weighed equally) by accelerated gradient steps; y is 1 or -1."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = ahead = np.zeros(x.shape[1], np.float32)
    step, t = 1.0 / (4.0 + ridge), 1.0
    for _ in range(rounds):
        short = np.maximum(0, 1 - y * (x @ ahead)) * weight
        new = ahead - step * (ridge * ahead - 2 * x.T @ (short * y).astype(np.float32))
        t, was = (1 + sqrt(1 + 4 * t * t)) / 2, t
        w, ahead = new, new + np.float32((was - 1) / t) * (new - w)
    return w[:-1], float(w[-1])


def families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Groups of languages by average linkage of the mean vectors' cosines."""
    groups = [[k] for k in sorted(means)]
    unit = {k: v / max(1e-9, float(np.linalg.norm(v))) for k, v in means.items()}
    alike = lambda g, h: sum(float(unit[a] @ unit[b]) for a in g for b in h) / (len(g) * len(h))
    while len(groups) > ceil(sqrt(len(means))):
        i, j = max(combinations(range(len(groups)), 2), key=lambda p: alike(groups[p[0]], groups[p[1]]))
        groups[i] = sorted(groups[i] + groups.pop(j))
    return groups


def densities(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Log density of each cell, relative to even ones, in the language that has most of it."""
    sums = [(x[label == k] ** 2).sum(axis=0, dtype=np.float64) for k in sorted(set(label))]
    return np.log(np.max([(n + 1 / CELLS) / (n.sum() + 1) for n in sums], axis=0) * CELLS)


class Known:
    """How far a text's trigrams are from those of learned rows, and beyond what it is strange.

    The mean log density of a text deviates by the spread among texts and by chance, which falls with the number of its
    different trigrams.  The deviations of learned rows are taken under the densities of the other half of them.
    """

    def __init__(self, x: np.ndarray, label: np.ndarray):
        self.limit = None
        if len(x) < LEAST_LEARNT:
            return
        half, mean, share = np.arange(len(x)) % 2 == 0, np.zeros(len(x)), np.zeros(len(x))
        for own in (half, ~half):
            mean[own], share[own] = self._mean(x[own], densities(x[~own], label[~own]))
        self.log = densities(x, label)
        q = (x**2).mean(axis=0, dtype=np.float64)
        self.chance = float((q * (self.log - q @ self.log) ** 2).sum())
        self.usual = float(np.median(mean))
        self.spread = max(0.05, 1.4826 * float(np.median(np.abs(mean - self.usual))))
        self.limit = BEYOND * max(1.0, float(np.quantile(self._off(mean, share), 0.99)))

    @staticmethod
    def _mean(x: np.ndarray, log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = x**2
        return p @ log, (p**2).sum(axis=1)

    def _off(self, mean: np.ndarray, share: np.ndarray) -> np.ndarray:
        return np.where(share > 0, (self.usual - mean) / np.sqrt(self.spread**2 + self.chance * share), 0.0)

    def strange(self, x: np.ndarray) -> np.ndarray:
        """True for vectors in no learned language; texts without a trigram are not strange."""
        return np.zeros(len(x), bool) if self.limit is None else self._off(*self._mean(x, self.log)) > self.limit


class LanguageModel:
    """Families, their one-versus-rest SVMs, one-versus-one SVMs in each family, and what is known at all."""

    def __init__(self, x: np.ndarray, y: list[str]):
        label = np.array(y, dtype=object)
        self.langs = sorted(set(y))
        self.groups = families({k: x[label == k].mean(axis=0) for k in self.langs}) if self.langs else []
        side = lambda own: np.where(np.isin(label, own), 1.0, -1.0).astype(np.float32)
        self.family = [linear_svm(x, side(g)) for g in self.groups] if len(self.groups) > 1 else []
        self.pairs = {}
        for g in self.groups:
            for a, b in combinations(g, 2):
                rows = np.isin(label, [a, b])
                self.pairs[a, b] = linear_svm(x[rows], side([a])[rows])
        self.known = Known(x, label)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and confidence (0 to 1, 0 if strange) of each vector; ties go to the earlier family and language."""
        rows = len(x)
        lang, score = np.full(rows, "und", dtype=object), np.zeros(rows)
        if not self.langs:
            return lang, score
        squash = lambda m: 1 / (1 + np.exp(-np.clip(4 * m, -60, 60)))
        if self.family:
            m = np.stack([x @ w + b for w, b in self.family], axis=1)
            own, sure = m.argmax(axis=1), squash(m.max(axis=1))
        else:
            own, sure = np.zeros(rows, np.int64), np.ones(rows)
        for f, g in enumerate(self.groups):
            at = np.flatnonzero(own == f)
            votes, trust = np.zeros((len(at), len(g))), np.zeros((len(at), len(g)))
            for (i, a), (j, b) in combinations(enumerate(g), 2):
                w, c = self.pairs[a, b]
                p = squash(x[at] @ w + c)
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                trust[:, i] += p
                trust[:, j] += 1 - p
            best = (votes + trust / (len(g) + 1.0)).argmax(axis=1)
            lang[at] = np.array(g, dtype=object)[best]
            score[at] = sure[at] * (trust[np.arange(len(at)), best] / (len(g) - 1) if len(g) > 1 else 1.0)
        score[self.known.strange(x)] = 0.0
        return lang, score


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MOST_TRAIN) -> LanguageModel:
    """Fit on about `most` of the rows that are not held out, have a language and a letter; vectors are made on executors."""
    rows = df.where(~held_out(id_col) & F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = rows.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES).collect()
    each = max(1, most // max(1, len(counts)))
    picked, _ = per_class(rows, "lang", ["i", "text"], each, {r["lang"]: r["n"] for r in counts})
    # equal rows, which the hash takes together, can't bring more than twice as many
    picked = picked.orderBy(F.xxhash64("i", "text"), "i").limit(2 * each * max(1, len(counts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", rows=VECTORS):
                v = trigram_vectors(*utf8(part.column("text"))).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("i"), part.column("lang"), pa.array([x.tobytes() for x in v], pa.binary())], ["i", "lang", "v"])

    kind = dict(rows.dtypes)["i"]
    got = sorted(map_batches(picked, run, f"i {kind}, lang string, v binary").collect(), key=lambda r: (r["lang"], repr(r["i"]), r["v"]))
    x = np.array([np.frombuffer(r["v"], np.float16) for r in got], dtype=np.float32).reshape(len(got), CELLS)
    return LanguageModel(x, [r["lang"] for r in got])


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with lang_pred and score of every whole text; `und` and 0 where it is null or has no letter."""
    source = text_col if text_col in keep else "_text"  # a text that is kept anyway goes to Python once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, source, rows=VECTORS):
                lang, score = model.predict(trigram_vectors(*utf8(part.column(source))))
                dumb = ~np.array(part.column("_letter").to_pylist(), dtype=bool)
                lang[dumb], score[dumb] = "und", 0.0
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())], [*keep, "lang_pred", "score"])

    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letter")
    schema = ", ".join(f"`{c}` {k}" for c, k in df.select(*keep).dtypes)
    own = [] if source in keep else [F.col(text_col).alias(source)]
    return map_batches(df.select(*keep, *own, letter), run, f"{schema}, lang_pred string, score double")


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MOST_TRAIN) -> DataFrame:
    """Return (id, held_out, lang_pred, score) of every row, learnt from its rows that are not held out.

    Nulls: a null text, or one without a letter, is `und` with score 0; null languages teach nothing; a null id is
    hashed as the empty string.  A table that teaches no language gives `und` everywhere.  A text in no learned language
    has the nearest one with score 0, if at least LEAST_LEARNT rows teach.  Whole texts count, however
    long.  Repeated rows give equal rows; empty tables empty ones; other columns are ignored, whatever their names.
    """
    rows = df.select(F.col(id_col).alias(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("_t"))
    return predict(rows, train(df, id_col, text_col, lang_col, most), "_t", (id_col, "held_out"))
