"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its hashed character n-grams, with its
edges marked; a stretch of words is the mean of its words; a two-class softmax
reads that mean.  Vectors and softmax are trained jointly in numpy, so a
misspelling that training never saw still shares most n-gram vectors with the
word it distorts.

A few toxic words drown in the mean of a long text, so texts are read in
stretches of ``WINDOW`` words (all of them, whole texts) and a document scores
as its most toxic stretch.  Labels are per document, so training alternates:
first whole documents, then, for each toxic document, the stretch that the
model so far finds most toxic, against the likeliest false alarms of the others.

Fitting reads a bounded sample: at most ``SAMPLE_TOXIC`` toxic and
``SAMPLE_OTHER`` other labelled rows, those with the smallest hash of their id.
It runs in one task over that sample and gives one float per n-gram bucket
(the product of vectors and softmax), about 1 MB, whatever the corpus size.
Scoring reads every whole text once, without a shuffle.

Defined results: a null or empty text scores as the bias says, like any text
without words; labels may be null (not learnt from); repeated rows score
equally; with only one class in the sample the score is that class's share;
an empty table gives an empty result.  Only ``keep`` columns are carried.
"""

from __future__ import annotations

import io
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_share, holds, mix64

SAMPLE_TOXIC, SAMPLE_OTHER = 1200, 2000
WINDOW = 24
BUCKETS = 1 << 18
DIM = 4
GRAMS = (3, 4, 5)
#: n-grams seen in fewer word-document pairs of the sample teach nothing general.
MIN_SEEN = 12
EPOCHS = 30
TOXIC_WEIGHT = 0.35
#: Most toxic-looking stretches of a non-toxic document that a later round trains on.
HARD = 4
SEED = 11
KEPT_WORDS = 600_000
_STRIP = ".,;:!?()[]{}<>|\"'`*_~#%&$@=+-/\\"


def grams(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, number of the word) of all character n-grams of many words, edges marked."""
    marked = [f"<{w.strip(_STRIP)}>" for w in found]
    size = np.array([len(m) for m in marked], np.int64)
    points = np.frombuffer("".join(marked).encode("utf-32-le", errors="replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), size)
    room = np.repeat(np.cumsum(size), size) - np.arange(len(points))  # characters up to the word's end
    buckets, owners = [], []
    for n in GRAMS:
        at = np.flatnonzero(room >= n)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(1_000_003) + points[at + j]
        buckets.append((mix64(h) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _segment_sums(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; empty runs give 0."""
    out = np.zeros((len(starts), *values.shape[1:]), values.dtype)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = np.add.reduceat(values, starts[some], axis=0)
    return out


class Trainer:
    """Joint training of bucket vectors and softmax on a bounded sample."""

    def __init__(self, texts: list[str], labels: list[int]):
        vocabulary: dict[str, int] = {}
        docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(t)], np.int64) for t in texts]
        self.y = np.array(labels, np.int64)
        flat, owner = grams(list(vocabulary))
        seen = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=len(vocabulary))  # documents with the word
        common = np.bincount(flat, weights=seen[owner], minlength=BUCKETS) >= MIN_SEEN
        flat, owner = flat[common[flat]], owner[common[flat]]
        order = np.argsort(owner, kind="stable")
        flat, self.gram_owner = flat[order], owner[order]
        self.gram_n = np.bincount(owner, minlength=len(vocabulary))
        self.gram_at = np.cumsum(self.gram_n) - self.gram_n
        self.used, self.gram = np.unique(flat, return_inverse=True)
        self.docs = docs
        rng = np.random.default_rng(SEED)
        self.z = rng.normal(0, 0.3, (len(self.used), DIM)).astype(np.float32)
        self.out = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def word_vectors(self) -> np.ndarray:
        return _segment_sums(self.z[self.gram], self.gram_at, self.gram_n) / np.maximum(self.gram_n, 1)[:, None].astype(np.float32)

    def train(self, stretches: list[np.ndarray], y: np.ndarray, epochs: int, rate: float = 0.3) -> None:
        """Full-batch Adam; the toxic class weighs TOXIC_WEIGHT in total."""
        n = np.array([len(s) for s in stretches], np.int64)
        at = np.cumsum(n) - n
        flat = np.concatenate(stretches) if len(stretches) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        share = np.maximum(n, 1)[:, None].astype(np.float32)
        weight = np.where(y == 1, TOXIC_WEIGHT / max(1, (y == 1).sum()), (1 - TOXIC_WEIGHT) / max(1, (y == 0).sum())).astype(np.float32)
        goal = np.eye(2, dtype=np.float32)[y]
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.z, self.out, self.bias)]
        for step in range(1, epochs + 1):
            v = self.word_vectors()
            mean = _segment_sums(v[flat], at, n) / share
            logits = mean @ self.out + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - goal) * weight[:, None]
            d_out, d_bias = mean.T @ d, d.sum(axis=0)
            d_mean = (d @ self.out.T) / share
            d_word = np.stack([np.bincount(flat, weights=d_mean[owner, k], minlength=len(v)) for k in range(DIM)], axis=1)
            d_word /= np.maximum(self.gram_n, 1)[:, None]
            d_z = np.stack([np.bincount(self.gram, weights=d_word[self.gram_owner, k], minlength=len(self.z)) for k in range(DIM)], axis=1)
            for p_, g, (m1, m2) in zip((self.z, self.out, self.bias), (d_z, d_out, d_bias), moments, strict=True):
                g = g.astype(np.float32)
                m1 += 0.1 * (g - m1)
                m2 += 0.01 * (g * g - m2)
                p_ -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)

    def collapsed(self) -> tuple[np.ndarray, float]:
        """One float per bucket (its vector seen by the softmax) and the bias."""
        values = np.zeros(BUCKETS, np.float32)
        values[self.used] = self.z @ (self.out[:, 1] - self.out[:, 0])
        return values, float(self.bias[1] - self.bias[0])

    def fit(self) -> tuple[np.ndarray, float]:
        if len(set(self.y.tolist())) < 2:
            share = (self.y.sum() + 0.5) / (len(self.y) + 1)
            return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
        if not len(self.used):
            return np.zeros(BUCKETS, np.float32), 0.0
        self.train(self.docs, self.y, EPOCHS)
        windows = [[d[i : i + WINDOW] for i in range(0, max(len(d), 1), WINDOW)] for d in self.docs]
        for _ in range(2):
            seen = self.word_vectors() @ (self.out[:, 1] - self.out[:, 0])
            picked, y = [], []
            for parts, label in zip(windows, self.y, strict=True):
                parts = sorted(parts, key=lambda w: -seen[w].mean() if len(w) else np.inf)[: 1 if label == 1 else HARD]
                picked += parts
                y += [label] * len(parts)
            self.train(picked, np.array(y), EPOCHS, rate=0.1)
        return self.collapsed()


def untrained() -> bytes:
    """The model of an empty sample: one half for every text."""
    out = io.BytesIO()
    np.savez(out, values=np.zeros(BUCKETS, np.float32), bias=0.0)
    return out.getvalue()


def fit(docs: DataFrame, labels: DataFrame) -> bytes:
    """The model (numpy archive bytes) learnt from ``docs`` (doc_id, text) and
    ``labels`` (doc_id, toxic), both already limited to the rows to learn from."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    with_docs = docs.where("doc_id is not null").select("doc_id").join(known, "doc_id")
    with_docs = with_docs.distinct()
    counts = {bool(r["c"]): r["n"] for r in with_docs.groupBy((F.col("toxic") == 0).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = [
        with_docs.where((F.col("toxic") == 0) == F.lit(c)).where(hash_share(n, counts.get(c, 0))).orderBy(*order).limit(n)
        for c, n in ((True, SAMPLE_OTHER), (False, SAMPLE_TOXIC))
    ]
    chosen = F.broadcast(clean.unionByName(toxic))  # SAMPLE_OTHER + SAMPLE_TOXIC ids at most
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic", "doc_id").orderBy("doc_id").limit(SAMPLE_TOXIC + SAMPLE_OTHER)

    def run(batches):
        texts, y = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        values, bias = Trainer(texts, [int(v == 1) for v in y]).fit() if texts else (np.zeros(BUCKETS, np.float32), 0.0)
        out = io.BytesIO()
        np.savez(out, values=values, bias=bias)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    found = sample.coalesce(1).mapInArrow(run, "model binary").first()
    return bytes(found["model"]) if found else untrained()


class Scorer:
    def __init__(self, model: bytes):
        loaded = np.load(io.BytesIO(model))
        self.values, self.bias = loaded["values"], float(loaded["bias"])
        self.known = (self.values != 0).astype(np.float32)  # n-grams that training has seen
        self.kept: dict[str, float] = {}

    def learn(self, found: list[str]) -> None:
        """Values of new words: the mean over their n-grams."""
        if len(self.kept) + len(found) > KEPT_WORDS:
            self.kept.clear()
        flat, owner = grams(found)
        sums = np.bincount(owner, weights=self.values[flat], minlength=len(found))
        n = np.bincount(owner, weights=self.known[flat], minlength=len(found))
        self.kept.update(zip(found, (sums / np.maximum(n, 1)).tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Scores of a slice of texts; words are looked up once per slice."""
        split = [words(t) for t in texts]
        new = {w for found in split for w in found if w not in self.kept}
        if new and len(self.kept) + len(new) > KEPT_WORDS:
            new = {w for found in split for w in found}
        if new:
            self.learn(list(new))
        return [self.score(found) for found in split]

    def score(self, found: list[str]) -> float:
        """Probability of the most toxic stretch; the words are known."""
        if not found:
            x = self.bias
        else:
            v = np.array(list(map(self.kept.__getitem__, found)))
            at = np.arange(0, len(v), WINDOW)
            n = np.minimum(WINDOW, len(v) - at)
            x = float((np.add.reduceat(v, at) / n).max()) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(x, -60, 60))))


@lru_cache(maxsize=2)
def scorer(model: bytes) -> Scorer:
    return Scorer(model)


holds("toxicity", scorer.cache_clear)


def predict(docs: DataFrame, model: bytes, keep: list[str]) -> DataFrame:
    """``keep`` columns, score and predicted for every row."""
    kinds = dict(docs.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "score double, predicted int"

    def run(batches):
        own = scorer(shared.value)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            scores = np.array([x for i in range(0, len(texts), 500) for x in own.scores(texts[i : i + 500])], float)
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)
