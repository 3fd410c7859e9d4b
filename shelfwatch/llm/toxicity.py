"""Toxic passages: maximal-scoring segments over token log-odds, with extreme-value statistics.

Training counts, for every word and word start, the different texts of each class that have it;
log-odds with a Dirichlet prior give a score, kept where it is significant. A document is scanned
once: every word adds its log-odds less a constant drift, and the linear-time algorithm of Ruzzo
and Tompa yields all maximal segments. Karlin-Altschul statistics, fitted on clean documents, turn
a segment's score and the document's length into the chance of such a segment in clean text, and
a logistic curve turns that into the score of the document.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_slices, materialise

#: labelled rows to learn from, picked by hash; one in CALIBRATION of them fits the statistics
SAMPLE, CALIBRATION = 100_000, 4
#: smallest checksums that near copies agree in
MINIMA = 4
#: prior: this many background counts, and a floor for each unit
PRIOR, FLOOR = 500.0, 0.5
#: least significance and support of a unit, and the word starts that count beside whole words
LEAST_Z, LEAST_TEXTS, STARTS = 2.5, 3, (4, 5, 6)
#: taken off each word's log-odds, so that ordinary text scores below zero
DRIFT = 2.5
#: expected number of chance segments per document below which one is significant
SIGNIFICANT = 0.05
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    decay: float  # lambda of the segment statistics
    scale: float  # K
    bias: float
    slope: float


def units(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STARTS if len(word) > k)]


def _signature(text: str | None) -> int:
    """Of the text's three-word runs the MINIMA smallest checksums, as one: near copies mostly share them.

    Texts that share a passage only would need all of them to lie in it.
    """
    words = _WORD.findall((text or "").lower())
    runs = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    sums = {zlib.crc32(" ".join(r).encode("utf-8", "surrogatepass")) for r in runs}
    return zlib.crc32(" ".join(map(str, heapq.nsmallest(MINIMA, sums))).encode())


class Scanner:
    """Scores words; remembers the words it has met, up to a bound."""

    def __init__(self, lexicon: dict[str, float], remember: int = 500_000):
        self.lexicon, self.remember, self.known = lexicon, remember, {}

    def word(self, word: str) -> float:
        if (s := self.known.get(word)) is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            s = self.known[word] = max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)
        return s

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(words, segments): all maximal segments as (start, end, score) in code points.

        Maximal in the sense of Ruzzo and Tompa: no extension or part scores more. Words without
        log-odds only lower the running total, so just the others are visited.
        """
        text = text or ""
        low = text.lower()
        if len(low) != len(text):  # a character that grows when lower-cased would shift positions
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        words = _WORD.findall(low)
        score = self.word
        hits = [(i, s) for i, s in enumerate(map(score, words)) if s > DRIFT]
        if not hits:
            return len(words), []
        # stack of candidates: first word, last word, total before, total after
        stack: list[list[float]] = []
        total, at = 0.0, 0
        for i, s in hits:
            before = total - DRIFT * (i - at)
            total, at = before + s - DRIFT, i + 1
            new = [i, i, before, total]
            while True:
                k = len(stack) - 1
                while k >= 0 and stack[k][2] >= new[2]:
                    k -= 1
                if k < 0 or stack[k][3] >= new[3]:
                    stack.append(new)
                    break
                new = [stack[k][0], new[1], stack[k][2], new[3]]
                del stack[k:]
        spots = [m.span() for m in _WORD.finditer(low)]
        return len(words), [(spots[int(a)][0], spots[int(b)][1], hi - lo) for a, b, lo, hi in stack]


def surprise(model: Model, words: int, best: float) -> float:
    """-log of the chance that clean text of so many words has a segment of score ``best``."""
    if best <= 0 or words <= 0:
        return 0.0
    x = math.log(model.scale) + math.log(words) - model.decay * best
    if x < -30:
        return -x
    return -math.log(max(-math.expm1(-math.exp(min(x, 30.0))), 1e-300))


def probability(model: Model, words: int, best: float) -> float:
    z = model.bias + model.slope * surprise(model, words, best)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def _root(scores: Counter, drift: float) -> float:
    """The positive root of sum p exp(lambda s) = 1 for the word scores of clean text."""
    n = sum(scores.values())
    s = np.array(list(scores), float) - drift
    p = np.array(list(scores.values()), float) / max(n, 1)
    if not len(s) or s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * s, 700))).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 700))).sum() < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope, the slope not below zero; a ridge keeps separable data finite."""
    unit = max(float(x.std()), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / unit])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0) / unit)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), at most SAMPLE labelled rows.

    Rows without a label or id are left out; of labels for one id any toxic one counts. Of rows
    with nearly one text the one of the smallest id stays, with its own label. The lexicon has
    every significant unit of the sample, whose bound bounds it too, so both may be sent to every
    executor. Without labelled rows the model finds nothing and gives a small constant score.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    )
    rows = docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(materialise(picked)), "doc_id")
    signed = map_slices(rows, "_sign long", "_text", lambda: lambda texts: {"_sign": [_signature(t) for t in texts]})
    alike = signed.groupBy("_sign").agg(F.min(F.struct("doc_id", F.xxhash64("_text").alias("h"), "toxic")).alias("k"))
    chosen = alike.select("k.doc_id", "k.h", "k.toxic", (F.pmod("_sign", F.lit(CALIBRATION)) == 0).alias("fit"))
    chosen = materialise(chosen)
    rows = docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(chosen), "doc_id").where(F.xxhash64("_text") == F.col("h"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for body, toxic in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                found = set()
                for word in set(_WORD.findall((body or "").lower())):
                    found.update(units(word))
                seen[toxic != 0].update(found)
            for kind, counts in enumerate(seen):
                n, none = pa.array(counts.values(), pa.int64()), pa.array([0] * len(counts), pa.int64())
                clean, toxic = (none, n) if kind else (n, none)
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), clean, toxic], ["unit", "clean", "toxic"])

    counted = (
        rows.where("not fit").select("_text", "toxic").mapInArrow(count, "unit string, clean long, toxic long")
        .groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counted = materialise(counted)
    clean, toxic = (max(int(n or 0), 1) for n in counted.agg(F.sum("clean"), F.sum("toxic")).first())
    prior = F.lit(FLOOR) + F.lit(PRIOR / (clean + toxic)) * (F.col("clean") + F.col("toxic"))
    y, n = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(y / toxic) - F.log(n / clean)
    kept = (
        counted.where(F.col("toxic") >= LEAST_TEXTS)
        .select("unit", odds.alias("odds"), (odds / F.sqrt(1 / y + 1 / n)).alias("z"))
        .where(F.col("z") >= LEAST_Z)
    )
    lexicon = {r["unit"]: r["odds"] for r in kept.collect()}
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def scan():
        scanner = Scanner(sent.value)

        def work(texts: list) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("n", "best", "scores", "counts")}
            for body in texts:
                n, found = scanner.segments(body)
                marks = Counter(round(s, 2) for s in map(scanner.word, _WORD.findall((body or "").lower())) if s > 0)
                for k, v in zip(out, (n, max((s for _, _, s in found), default=0.0), list(marks), list(marks.values()))):
                    out[k].append(v)
            return out

        return work

    fields = "n long, best double, scores array<double>, counts array<long>"
    fit = map_slices(rows.where("fit").select("_text", "toxic"), fields, "_text", scan).drop("_text").toPandas()
    fit["toxic"] = (fit["toxic"] != 0).astype(int)
    harmless = fit[(fit.toxic == 0) & (fit.n > 0)]
    marks: Counter = Counter()
    for s, c in zip(harmless["scores"], harmless["counts"]):
        marks.update(dict(zip(s, c)))
    marks[0.0] += int(harmless["n"].sum()) - sum(marks.values())
    decay = _root(marks, DRIFT)
    waits = harmless["n"].to_numpy(float) * np.exp(-decay * harmless["best"].to_numpy(float))
    scale = float(len(waits) / waits.sum()) if len(waits) else 1.0
    if fit.toxic.nunique() < 2:
        share = (toxic_rows := float(fit.toxic.sum()) + 0.5) / (len(fit) + 1.0)
        share = min(max(share, 1e-3), 1 - 1e-3) if toxic_rows else 1e-3
        return Model(lexicon, decay, scale, math.log(share / (1 - share)), 0.0 if not lexicon else 1.0)
    raw = Model(lexicon, decay, scale, 0.0, 1.0)
    x = np.array([surprise(raw, n, b) for n, b in zip(fit["n"], fit["best"])])
    bias, slope = _logistic(x, fit["toxic"].to_numpy(float))
    return Model(lexicon, decay, scale, bias, slope)


PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and the significant ``passages`` of every whole text.

    ``expected`` is the number of passages as strong in clean text of that length. A null text
    counts as empty: no passage, the score of a text without evidence. Columns named ``score`` and
    ``passages`` are replaced; repeated rows are scored alike; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value
        scanner = Scanner(m.lexicon)

        def work(texts: list) -> dict[str, list]:
            scores, passages = [], []
            for body in texts:
                n, found = scanner.segments(body)
                scores.append(probability(m, n, max((s for _, _, s in found), default=0.0)))
                rated = [(a, b, s, m.scale * n * math.exp(max(-700.0, -m.decay * s))) for a, b, s in found]
                passages.append([dict(zip(("start", "end", "score", "expected"), r)) for r in rated if r[3] <= SIGNIFICANT])
            return {"score": scores, "passages": passages}

        return work

    return map_slices(docs, f"score double, passages {PASSAGES}", text, make)
