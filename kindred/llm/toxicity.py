"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Words are compared with a few dozen landmark words by the gap-weighted
subsequence kernel (length 3, decay 0.85, squared), which gaps and inserted characters
only dampen.  A sentence's kernel vector holds the largest kernel value of its
words for each landmark; the Nystroem map turns it into features of a linear
SVM, trained on labelled sentences: all of clean documents against, in every
toxic document, the sentence that the SVM itself finds most toxic (refined over
a few rounds, as documents are labelled and not sentences).  The score of a
document is the calibrated margin of its worst sentence.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import hash_sample, materialise, shipped
from kindred.llm.language_id import held_out

DECAY, LENGTH = 0.85, 3
#: Labelled documents of each class that the SVM is fitted on.
SAMPLE_DOCS = 6000
LANDMARKS, NEUTRAL = 72, 8
#: Kernel vectors kept of one training document, the strongest ones.
SENTENCES = 8
#: Share of a landmark's letters that a word must have, also in order, and the
#: least kernel value that counts; below, words are far from the landmark.
SHARED, LEAST = 0.7, 0.35
THRESHOLD = 0.3
CACHE = 500_000
#: Total cost of margin errors, the same for either class.
COST = 1000.0
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][\s._*\-]{1,3}){3,}[^\W\d_](?!\w)")


def ssk(words: list[str], marks: list[str]) -> np.ndarray:
    """Gap-weighted subsequence kernel of every pair (words[i], marks[i])."""
    lw, lm = max(map(len, words)), max(map(len, marks))
    a = np.zeros((len(words), lw), dtype=np.int32)
    b = np.full((len(marks), lm), -1, dtype=np.int32)
    for i, (w, m) in enumerate(zip(words, marks)):
        a[i, :len(w)] = [ord(c) for c in w]
        b[i, :len(m)] = [ord(c) for c in m]
    same = a[:, :, None] == b[:, None, :]
    n = len(words)
    kp = np.ones((n, lw + 1, lm + 1))
    total = np.zeros(n)
    for i in range(1, LENGTH + 1):
        if i == LENGTH:
            return total + DECAY ** 2 * (same * kp[:, :-1, :-1]).sum(axis=(1, 2))
        nxt = np.zeros_like(kp)
        for s in range(lw):
            # row of K'': sum over matches in the mark, decayed to its end
            hit = same[:, s, :] * kp[:, s, :-1] * DECAY ** 2
            run = np.zeros(n)
            for t in range(lm):
                run = run * DECAY + hit[:, t]
                nxt[:, s + 1, t + 1] = DECAY * nxt[:, s, t + 1] + run
        kp = nxt
    return total


def kernel_values(words: list[str], marks: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared normalised kernel of the pairs (words[i], marks[j])."""
    own_w, own_m = ssk(words, words), ssk(marks, marks)
    order = np.lexsort(([len(marks[m]) for m in j], [len(words[w]) for w in i]))  # equal lengths need no padding
    k = np.empty(len(order))
    for lo in range(0, len(order), 1024):
        at = order[lo:lo + 1024]
        k[at] = ssk([words[w] for w in i[at]], [marks[m] for m in j[at]])
    return k ** 2 / np.maximum(own_w[i] * own_m[j], 1e-300)


def common_subsequence(a: np.ndarray, mark: str) -> np.ndarray:
    """Length of the longest common subsequence of each row of codes with ``mark``."""
    row = np.zeros((len(mark) + 1, len(a)), dtype=np.int8)
    for s in range(a.shape[1]):
        before = row[0]
        for t, c in enumerate(mark, 1):
            here = row[t].copy()
            row[t] = np.where(a[:, s] == ord(c), before + 1, np.maximum(row[t], row[t - 1]))
            before = here
    return row[-1]


def tokens(text: str) -> list[str]:
    """Lower-cased runs between spaces, and runs of letters spelled one by one."""
    text = text.lower()
    return text.split() + ["".join(c for c in m if c.isalpha()) for m in _SPACED.findall(text)]


_OTHER = re.compile(r"[\W\d_]+")


def letters(token: str) -> str:
    return token if token.isalpha() else _OTHER.sub("", token)


def letter_bits(codes: np.ndarray) -> np.ndarray:
    bits = np.where(codes > 0, np.uint64(1) << (codes & 63).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


class Kernel:
    """Kernel vectors of words, with a bounded cache of tokens seen."""

    def __init__(self, marks: list[str], toxic: int):
        self.marks, self.toxic = marks, toxic
        self.width = max(2 * len(m) + 3 for m in marks[:toxic])
        self.rows: dict[str, np.ndarray] = {}
        self.none: set[str] = set()

    def near(self, words: list[str]) -> np.ndarray:
        """Matrix words x landmarks: enough letters in common, in order too."""
        codes = np.array(words, dtype=f"U{self.width}").reshape(-1, 1).view(np.uint32).reshape(len(words), -1)
        lens, bits = (codes > 0).sum(axis=1), letter_bits(codes)
        out = np.zeros((len(words), len(self.marks)), dtype=bool)
        for j, m in enumerate(self.marks):
            own = letter_bits(np.array([[ord(c) for c in m]], dtype=np.uint32))
            some = np.flatnonzero((lens >= len(m) - 2) & (lens <= 2 * len(m) + 3)
                                  & (np.bitwise_count(bits & own) >= SHARED * np.bitwise_count(own)))
            if len(some):
                out[some, j] = common_subsequence(codes[some, :2 * len(m) + 3], m) >= SHARED * len(m)
        return out

    def learn(self, new: set[str]) -> None:
        """Fill the cache: tokens without a kernel value that counts, and rows of the rest."""
        if len(self.none) + len(self.rows) > CACHE:
            self.none.clear()
            self.rows.clear()
        new = list(new)
        words = [letters(t) for t in new]
        fits = [i for i, w in enumerate(words) if LENGTH <= len(w) <= self.width]
        close = self.near([words[i] for i in fits]) if fits else np.zeros((0, len(self.marks)), dtype=bool)
        rows = {}
        part = np.flatnonzero(close[:, :self.toxic].any(axis=1))
        for lo in range(0, len(part), 2048):
            own = part[lo:lo + 2048]
            at, j = np.nonzero(close[own])
            picked = [words[fits[i]] for i in own]
            k = np.zeros((len(own), len(self.marks)))
            if len(at):
                k[at, j] = kernel_values(picked, self.marks, at, j)
            for i, v in zip(own, k):
                if v[:self.toxic].max() >= LEAST ** 2:
                    rows[new[fits[i]]] = v
        self.none.update(t for t in new if t not in rows)
        self.rows.update(rows)

    def vectors(self, texts) -> list[np.ndarray]:
        """Per text the kernel vectors of its sentences (those with a value)."""
        split = [set(tokens(t)) if t else set() for t in texts]
        new = set()
        for words in split:
            new |= words - self.none
        new -= self.rows.keys()
        if new:
            self.learn(new)
        out = []
        for text, words in zip(texts, split):
            if not any(w in self.rows for w in words):
                out.append(np.zeros((0, len(self.marks))))
                continue
            rows = []
            for sentence in _SENTENCE.split(text):
                own = [self.rows[w] for w in set(tokens(sentence)) if w in self.rows]
                if own:
                    rows.append(np.max(own, axis=0))
            out.append(np.array(rows).reshape(-1, len(self.marks)))
        return out


def linear_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """L2-regularised squared hinge loss by Newton steps in the primal."""
    w = np.zeros(x.shape[1])

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()

    for _ in range(50):
        off = np.maximum(0, 1 - y * (x @ w))
        grad = w - 2 * x.T @ (cost * y * off)
        inside = off > 0
        h = np.eye(len(w)) + 2 * (x[inside] * cost[inside, None]).T @ x[inside]
        step, size = np.linalg.solve(h, grad), 1.0
        if np.abs(step).max() < 1e-8:
            break
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return w


class Classifier:
    def __init__(self, marks, toxic, docs: list[np.ndarray], labels: np.ndarray, shares: tuple[float, float]):
        """``shares``: labelled documents per sampled one, clean and toxic."""
        self.kernel = Kernel(marks, toxic)
        n = len(marks)
        gram = kernel_values(marks, marks, np.repeat(np.arange(n), n), np.tile(np.arange(n), n)).reshape(n, n)
        value, vector = np.linalg.eigh(gram)
        self.map = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        bags = [np.vstack((d, np.zeros((1, len(marks))))) for d in docs]
        flat = np.vstack([b for b, l in zip(bags, labels) if not l] or [np.zeros((1, len(marks)))])
        flat, n_flat = np.unique(np.round(flat, 6), axis=0, return_counts=True)
        toxic_bags = [b for b, l in zip(bags, labels) if l]
        pick = [int(b[:, :toxic].max(axis=1).argmax()) for b in toxic_bags]
        spelled, n_spelled = self.respelled(marks[:toxic], toxic_bags)
        self.w = np.zeros(len(marks) + 1)
        for _ in range(3 if toxic_bags else 0):
            pos = np.array([b[i] for b, i in zip(toxic_bags, pick)])
            pos, n_pos = np.unique(np.round(pos[pos.any(axis=1)] if pos.any() else pos, 6), axis=0, return_counts=True)
            pos, n_pos = np.vstack((pos, spelled)), np.concatenate((n_pos, n_spelled))
            x = self.features(np.vstack((pos, flat)))
            y = np.concatenate((np.ones(len(pos)), -np.ones(len(flat))))
            self.w = linear_svm(x, y, COST * np.concatenate((n_pos / n_pos.sum(), n_flat / n_flat.sum())))
            pick = [int(self.margin(b).argmax()) for b in toxic_bags]
        worst = np.array([self.margin(b).max() for b in bags]) if bags else np.zeros(1)
        self.a, self.b = self.platt(worst, np.asarray(labels, dtype=float) if bags else np.zeros(1), shares)

    def respelled(self, marks, bags) -> tuple[np.ndarray, np.ndarray]:
        """Kernel vectors of toxic landmarks with one character doubled, dropped
        or put in between, and their weights: together as much as the toxic
        documents that have the landmark as it is."""
        rows, weights = [np.zeros((0, len(self.kernel.marks)))], [np.zeros(0)]
        for j, m in enumerate(marks):
            inner = range(1, len(m))
            words = [m[:i] + c + m[i:] for i in inner for c in (m[i], "x")] + [m[:i] + m[i + 1:] for i in inner]
            found = [v for v in self.kernel.vectors(words) if len(v)]
            support = sum(b[:, j].max() > 0.99 for b in bags)
            if found:
                rows.append(np.vstack(found))
                weights.append(np.full(len(found), support / len(found)))
        return np.vstack(rows), np.concatenate(weights)

    def features(self, k: np.ndarray) -> np.ndarray:
        return np.hstack((k @ self.map, np.full((len(k), 1), 2.0)))

    def margin(self, k: np.ndarray) -> np.ndarray:
        return self.features(k) @ self.w

    @staticmethod
    def platt(s, y, shares):
        c = np.where(y > 0, shares[1], shares[0])
        a, b = 1.0, 0.0
        for _ in range(200):  # Newton steps on the weighted logistic loss, slightly regularised
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            g = np.array([(c * (p - y) * s).sum() + 1e-3 * a, (c * (p - y)).sum() + 1e-3 * b])
            v = c * p * (1 - p)
            h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        return a, b

    def scores(self, texts) -> np.ndarray:
        none = self.margin(np.zeros((1, len(self.kernel.marks))))[0]
        s = np.array([max([none, *self.margin(v)]) if len(v) else none for v in self.kernel.vectors(texts)])
        return 1 / (1 + np.exp(-np.clip(self.a * s + self.b, -30, 30)))


def landmark_words(sample: DataFrame) -> tuple[list[str], int]:
    """Words whose distinct contexts (neighbouring words) lean most to toxic
    documents, then some frequent neutral ones.  Contexts, not documents, are
    counted, so copies of one document are no evidence."""
    words = F.filter(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]+", "")), lambda w: w != "")
    rows = sample.select("toxic", words.alias("w")).select("toxic", F.explode(F.transform("w", lambda w, i: F.struct(
        w.alias("word"), F.xxhash64(F.when(i > 0, F.get("w", i - 1)), F.get("w", i + 1)).alias("ctx")))).alias("x"))
    rows = rows.select("toxic", "x.word", "x.ctx").filter(F.length("word").between(4, 24)).distinct()
    counts = materialise(rows.groupBy("word").agg(
        F.sum(F.col("toxic").cast("long")).alias("t"), F.sum((1 - F.col("toxic")).cast("long")).alias("c")), "words")
    total = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not total or not total.t or not total.c:
        return [], 0
    n = total.t + total.c
    both = F.col("t") + F.col("c")
    g2 = 2 * (F.col("t") * F.log(F.greatest(F.col("t"), F.lit(0.5)) * n / (both * total.t))
              + F.col("c") * F.log(F.greatest(F.col("c"), F.lit(0.5)) * n / (both * total.c)))
    lean = counts.filter((F.col("t") >= 5) & (F.col("t") * total.c > 3 * F.col("c") * total.t)).withColumn("g2", g2)
    toxic = [(r.word, r.g2) for r in lean.orderBy(F.desc("g2"), "word").limit(LANDMARKS).collect()]
    toxic = [w for w, g in toxic if g >= max(11.0, 0.015 * toxic[0][1])]
    neutral = counts.orderBy(F.desc("c"), "word").limit(NEUTRAL + len(toxic)).collect()
    return toxic + [r.word for r in neutral if r.word not in toxic][:NEUTRAL], len(toxic)


def fit(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """Classifier of the labelled training rows; None without both classes."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(4, 2))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    known = materialise(known, "labels")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    chosen = hash_sample(known.filter("toxic = 0"), SAMPLE_DOCS).unionByName(hash_sample(known.filter("toxic = 1"), SAMPLE_DOCS))
    sample = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE_DOCS ids at most
    sample = materialise(sample, "labelled")
    marks, toxic = landmark_words(sample)
    if not toxic:
        return None
    shared = docs.sparkSession.sparkContext.broadcast((marks, toxic))

    @F.pandas_udf("array<array<double>>")
    def kernel_vectors(text: pd.Series) -> pd.Series:
        kernel = Kernel(*shared.value)
        out = []
        for v in kernel.vectors(list(text)):
            strong = np.argsort(-v[:, :toxic].max(axis=1), kind="stable")[:SENTENCES] if len(v) else []
            out.append([row.tolist() for row in v[strong]] if len(v) else [])
        return pd.Series(out)

    rows = sample.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select(
        "doc_id", "toxic", kernel_vectors("text").alias("v")).toPandas().sort_values("doc_id")
    bags = [np.array([np.asarray(r, dtype=float) for r in v]).reshape(-1, len(marks)) for v in rows["v"]]
    y = rows["toxic"].to_numpy()
    shares = tuple(sizes[c] / max(1, int((y == c).sum())) for c in (0, 1))
    return Classifier(marks, toxic, bags, y, shares)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents``, ``labels(doc_id, toxic)`` -> one row each: doc_id, held_out,
    score (probability of label 1), predicted (score >= 0.3).

    Null and empty texts get the score of a text without any suspect word; a
    document with conflicting labels counts as toxic; repeated rows get the same
    score; without labels of both classes every score is 0; an empty table gives
    no rows.  Only doc_id and text are read of documents."""
    classifier, _ = shipped(docs.sparkSession, fit(docs, labels))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        model = classifier()
        if model is None:
            return pd.Series(np.zeros(len(text)))
        return pd.Series(np.concatenate([model.scores(list(text[i:i + 500])) for i in range(0, len(text), 500)])
                         if len(text) else np.zeros(0))

    out = docs.select("doc_id", held_out(4, 2).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
