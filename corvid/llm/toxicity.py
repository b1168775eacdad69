"""Toxicity: a counterfactually regularised linear classifier.

Features are the words of a text and their beginnings (presence, by 64-bit
hash) whose toxic share differs clearly from that of all labelled texts. The
loss is the logistic loss (both classes weighing the same), an L1 penalty that keeps few features, and
a counterfactual penalty: where a labelled text names a group, the term is
swapped for the other terms of its category and the squared change of the score
(before the sigmoid) is penalised, so a neutral mention of a group gets no
weight of its own.

The model is fitted on at most ``MAX_TRAIN`` labelled rows (those with the least
hash of doc_id, whole texts); every document is scored, whole.

Defined cases: a null or empty text has the score of a text without features; a
null doc_id is never held out nor trained on; repeated label rows count as their
largest label, null labels not at all; of documents that share a labelled id the one
with the least text hash is trained on; without labelled rows of both classes
every score is the share of toxic rows seen (0 if there is none); extra columns
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.hashing import NOT_LETTER, Words, chunks

MAX_TRAIN = 6000
MIN_DOCS = 5
MIN_Z = 4.0
BEGINNINGS = (4, 6)
L1 = 1e-4
COUNTERFACTUAL = 1.0
STEPS = 300
THRESHOLD = 0.7

# Categories of identity terms; a term is swapped within its line.
IDENTITY_TERMS = tuple(tuple(line.split()) for line in """
women men girls boys
woman man girl boy
muslims christians jews hindus buddhists atheists
muslim christian jewish hindu buddhist atheist
black white asian latino african european
gay straight lesbian bisexual transgender
immigrants refugees natives foreigners
disabled blind deaf elderly young
femmes hommes filles garçons
musulmans chrétiens juifs bouddhistes athées
noirs blancs asiatiques africains
immigrés réfugiés étrangers
frauen männer mädchen jungen
muslime christen juden buddhisten atheisten
schwarze weiße asiaten afrikaner
einwanderer flüchtlinge ausländer
mujeres hombres niñas niños
musulmanes cristianos judíos budistas ateos
negros blancos asiáticos africanos
inmigrantes refugiados extranjeros
""".strip().splitlines())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the words and beginnings, repeats included."""
    w = Words(texts, NOT_LETTER)
    kinds = [w.hashes()] + [w.hashes(k) + np.uint64(k) for k in BEGINNINGS]
    return np.tile(w.doc, len(kinds)), np.concatenate(kinds)


def lowered(text: str | None) -> bytes:
    return text.lower().encode() if isinstance(text, str) else b""


def swaps() -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Hash of a term: features that go and come for each swap of it."""
    out = {}
    for line in IDENTITY_TERMS:
        own = [np.unique(features([t.encode()])[1]) for t in line]
        for i, t in enumerate(line):
            key = int(Words([t.encode()], NOT_LETTER).hashes()[0])
            out[key] = [(np.setdiff1d(own[i], o), np.setdiff1d(o, own[i])) for j, o in enumerate(own) if j != i]
    return out


@dataclass
class Model:
    keys: np.ndarray  # sorted feature hashes with a weight
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for first, part in chunks(map(lowered, texts)):
            doc, h = features(part)
            if not len(self.keys) or not len(h):
                continue
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[at] == h
            pair = np.unique(doc[hit] * np.int64(len(self.keys)) + at[hit])
            out[first:first + len(part)] += np.bincount(pair // len(self.keys), self.weights[pair % len(self.keys)], len(part))
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(rows: list[np.ndarray], labels: np.ndarray, l1: float = L1, counterfactual: float = COUNTERFACTUAL,
        steps: int = STEPS, min_docs: int = MIN_DOCS) -> Model:
    """``rows``: the distinct feature hashes of each labelled text."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 40.0 if share else -40.0)
    keys, seen = np.unique(np.concatenate(rows), return_counts=True)
    common = seen >= min_docs
    keys, seen, toxic = keys[common], seen[common], np.zeros(int(common.sum()))
    found = []
    for r, bad in zip(rows, labels):
        at = np.minimum(np.searchsorted(keys, r), max(len(keys) - 1, 0))
        at = at[keys[at] == r] if len(keys) else at[:0]
        toxic[at] += bad
        found.append(at.astype(np.int32))
    keep = np.abs(toxic - share * seen) >= MIN_Z * np.sqrt(seen * share * (1 - share))
    number = np.cumsum(keep) - 1
    found = [number[at[keep[at]]] for at in found]
    keys = keys[keep]
    doc, col = np.repeat(np.arange(len(rows)), [len(at) for at in found]), np.concatenate(found)
    # Counterfactual differences: a sparse row for each swap of each term that a labelled text names, kept as a
    # feature or not, scaled by the root of the number of those texts (their rows are equal).
    place, diff, terms = {int(k): i for i, k in enumerate(keys)}, [], swaps()
    own = np.array(sorted(terms), np.uint64)
    for term, texts in zip(*np.unique(np.concatenate([r[np.isin(r, own)] for r in rows]), return_counts=True)):
        for gone, come in terms[int(term)]:
            part = [(place[int(h)], s * np.sqrt(texts)) for hs, s in ((gone, -1.0), (come, 1.0)) for h in hs if int(h) in place]
            if part:
                diff.append(part)
    d_row = np.repeat(np.arange(len(diff)), [len(x) for x in diff])
    d_col, d_val = np.array([c for x in diff for c, _ in x], int), np.array([s for x in diff for _, s in x], float)

    n, k = len(rows), len(keys)
    mass = np.where(labels, 0.5 / share, 0.5 / (1 - share))  # both classes weigh the same
    w, b, z, zb, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    # A bound of the curvature by power iterations on [X 1] and the differences.
    v = np.ones(k) / np.sqrt(max(k, 1))
    for _ in range(15):
        u = np.bincount(col, (mass * np.bincount(doc, v[col], n))[doc], k) * 0.25 / n
        if len(diff):
            u += 2 * counterfactual / n * np.bincount(d_col, np.bincount(d_row, v[d_col] * d_val, len(diff))[d_row] * d_val, k)
        size = np.linalg.norm(u) or 1.0
        v = u / size
    rate = 1 / (1.3 * size + 0.5)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, z[col], n) + zb, -40, 40))) - labels
        p = p * mass
        grad = np.bincount(col, p[doc], k) / n
        if len(diff):
            change = np.bincount(d_row, z[d_col] * d_val, len(diff))
            grad += 2 * counterfactual / n * np.bincount(d_col, change[d_row] * d_val, k)
        new = z - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        nb, nt = zb - rate * p.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    some = w != 0
    return Model(keys[some], w[some], b)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          max_train: int = MAX_TRAIN, **options) -> Model:
    """Fit on labelled rows that are not held out."""
    lab = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
           .groupBy(F.col(doc_id).alias("i")).agg(F.max(label).alias("y"))
           .orderBy(F.xxhash64("i"), "i").limit(max_train))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, part in chunks(map(lowered, b["t"])):
                doc, h = features(part)
                order = np.argsort(doc, kind="stable")
                at, h = np.searchsorted(doc[order], np.arange(len(part) + 1)), h[order]
                yield pd.DataFrame({"i": b["i"][first:first + len(part)].to_numpy(), "y": b["y"][first:first + len(part)].to_numpy(),
                                    "h": [np.unique(h[at[k]:at[k + 1]]).tobytes() for k in range(len(part))]})

    # At most max_train labels: small enough to send to every task, so only texts of labelled ids are shuffled, one
    # of each id: what is collected is bounded by max_train rows, however many rows repeat an id.
    got = (docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).join(F.broadcast(lab), "i")
           .groupBy("i").agg(F.max("y").alias("y"), F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("one"))
           .select(F.col("i").cast("string"), F.col("y").cast("double"), F.col("one.t").alias("t"))
           .mapInPandas(rows, "i string, y double, h binary")).toPandas()
    got = got.sort_values("i", kind="stable")
    return fit([np.frombuffer(h, np.uint64) for h in got["h"]], got["y"].to_numpy() > 0, **options)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    names = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            yield pd.Series(model.scores(t.tolist()))

    udf = F.pandas_udf(run, "double")
    return (docs.select(*names, held_out(F.col(doc_id)).alias("held_out"), udf(F.col(text)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    label: str = "toxic", **options) -> DataFrame:
    return score(docs, train(docs, labels, doc_id, text, label, **options), doc_id, text)
