"""Hierarchical language identification.

Whole texts become hashed character n-gram vectors (square roots of counts,
unit length). Languages whose centroids are alike form a family. A multinomial
model predicts the family; inside it one linear support vector machine per
pair of languages votes. Models are fitted with ``pyspark.ml`` on a bounded
sample of labelled rows (``TRAIN_ROWS``, dealt evenly over the languages by a
hash of the row, ``LEAST_ROWS`` for each of very many) and applied to all rows
in numpy inside Arrow tasks. Every language with a labelled text is learned.

Learned from: rows with a language whose crc32(doc_id as text) mod 4 is not 2;
a null id counts as held out. Only the text is an input of a prediction.

Defined cases: null text or a text without a letter is ``und`` with score 0;
with no labelled row every row is ``und``; with one language it is predicted
for every text with a letter (score 1); repeated rows are predicted alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import under_plain_names, handed_off

DIMENSIONS = 4096
GRAMS = (1, 2, 3)
#: labelled rows that fit the models, over all languages
TRAIN_ROWS = 4000
#: rows a language has at least in the sample, if it has as many
LEAST_ROWS = 10
#: pair machines that are fitted at a time
FITS = 8
#: rows of one dense feature block
BLOCK_ROWS = 256
ITERATIONS = 30
UNKNOWN = "und"


def _has_letter(lowered: list[str]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, t)) for t in lowered), bool, len(lowered))


_KEPT = np.full(256, 0x20, np.uint8)
_KEPT[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEPT[0x80:] = np.arange(0x80, 0x100)


def features(lowered: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Unit vectors of hashed byte n-grams of lower-cased texts."""
    data, start, end = T.joined([t.encode() for t in lowered])
    data = _KEPT[data].astype(np.int64)
    row = np.repeat(np.arange(len(lowered)), end - start + 1)
    shift = 32 - (dimensions - 1).bit_length()
    out = np.zeros(len(lowered) * dimensions)
    code = np.zeros(len(data), np.int64)
    for k in range(max(GRAMS)):
        code = (code[: len(data) - k] << 8) | data[k:]
        if k + 1 in GRAMS and len(code):
            inside = (row[: len(code)] == row[k:]) & (code != 0x202020 >> 8 * (2 - min(k, 2)))
            hashed = ((code + (k << 28)) * 2654435761 & 0xFFFFFFFF) >> shift
            out += np.bincount((row[: len(code)] * dimensions + hashed)[inside], minlength=len(out))
    out = np.sqrt(out.reshape(len(lowered), dimensions))
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


@dataclass
class Model:
    """families: languages of each; weights are (dimensions x outputs)."""

    families: list[list[str]]
    family_weights: np.ndarray
    family_bias: np.ndarray
    pairs: list[dict[tuple[int, int], tuple[np.ndarray, float]]] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of feature rows."""
        z = x @ self.family_weights + self.family_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        chosen = z.argmax(axis=1)
        language, score = np.empty(len(x), object), z[np.arange(len(x)), chosen]
        for f, members in enumerate(self.families):
            mine = np.flatnonzero(chosen == f)
            if not len(mine):
                continue
            votes, sure = np.zeros((2, len(mine), len(members)))
            for (a, b), (w, bias) in self.pairs[f].items():
                p = 1 / (1 + np.exp(-np.clip(x[mine] @ w + bias, -30, 30)))   # towards b
                votes[:, a] += p < 0.5
                votes[:, b] += p >= 0.5
                sure[:, a] += 1 - p
                sure[:, b] += p
            best = (votes + sure / (1 + len(members))).argmax(axis=1)
            language[mine] = np.asarray(members, object)[best]
            if len(members) > 1:
                score[mine] *= sure[np.arange(len(mine)), best] / (len(members) - 1)
        return language, np.clip(score, 0, 1)


def families_of(languages: list[str], centroids: np.ndarray) -> list[list[str]]:
    """Average-linkage clusters of languages more alike than the mean pair."""
    unit = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T
    if len(languages) < 3:
        return [[x] for x in languages]
    cut = alike[np.triu_indices(len(languages), 1)].mean()
    groups, size = [[i] for i in range(len(languages))], np.ones(len(languages))
    while len(groups) > 1:
        mean = np.where(np.triu(np.ones(alike.shape, bool), 1), alike / np.outer(size, size), -np.inf)
        a, b = map(int, np.unravel_index(mean.argmax(), mean.shape))
        if mean[a, b] <= cut:
            break
        groups[a] += groups.pop(b)
        alike[a] += alike[b]        # sums over both groups' members
        alike[:, a] += alike[:, b]
        alike = np.delete(np.delete(alike, b, 0), b, 1)
        size[a] += size[b]
        size = np.delete(size, b)
    return [[languages[i] for i in sorted(g)] for g in sorted(groups)]


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, text = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        lowered = [t.lower() for t in text]
        ok = _has_letter(lowered)
        for lo in range(0, len(text), BLOCK_ROWS):
            keep = np.flatnonzero(ok[lo:lo + BLOCK_ROWS])
            x = features(lowered[lo:lo + BLOCK_ROWS])[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang[lo + k] for k in keep], pa.string()),
                 pa.array(list(x), pa.list_(pa.float64()))], names=["lang", "x"])


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)), F.lit(2)) == 2


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on the labelled rows that are not held out; None without any."""
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    labelled = docs.filter("lang is not null and text rlike '\\\\p{L}'").filter(~held_out()).withColumn(
        "__lang_draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20))
    counts = handed_off(labelled.groupBy("lang").agg(F.count("*").alias("__lang_n"), F.min("__lang_draw").alias("__lang_least")),
                        "langid-counts")
    n = counts.count()
    if not n:
        return None
    share = max(-(-train_rows // n), LEAST_ROWS)
    sample = labelled.join(counts, "lang").filter(
        (F.col("__lang_draw") < share / F.col("__lang_n")) | (F.col("__lang_draw") == F.col("__lang_least")))
    rows = handed_off(sample.select("lang", "text").mapInArrow(T.tidied(_train_rows), "lang string, x array<double>"),
                      "langid-train")
    rows = rows.select("lang", array_to_vector("x").alias("features"))
    means = {r.lang: r.m.toArray() for r in
             rows.groupBy("lang").agg(Summarizer.mean(F.col("features")).alias("m")).collect()}
    if not means:
        return None
    languages = sorted(means)
    families = families_of(languages, np.array([means[x] for x in languages]))
    family = F.create_map(*[F.lit(v) for k, f in enumerate(families) for x in f for v in (x, float(k))])
    weights, bias = np.zeros((DIMENSIONS, len(families))), np.zeros(len(families))
    if len(families) > 1:
        m = LogisticRegression(maxIter=ITERATIONS, regParam=1e-4, family="multinomial").fit(
            rows.withColumn("label", F.element_at(family, F.col("lang"))))
        weights, bias = m.coefficientMatrix.toArray().T, m.interceptVector.toArray()
    model = Model(families, weights, bias, [{} for _ in families])

    def machine(f: int, a: int, b: int) -> None:
        first, second = families[f][a], families[f][b]
        two = rows.filter(F.col("lang").isin(first, second)).withColumn(
            "label", (F.col("lang") == second).cast("double"))
        m = LinearSVC(maxIter=ITERATIONS, regParam=1e-3).fit(two)
        model.pairs[f][a, b] = (m.coefficients.toArray(), float(m.intercept))

    with ThreadPoolExecutor(FITS) as pool:
        list(pool.map(lambda x: machine(*x), [(f, a, b) for f, members in enumerate(families)
                                              for a, b in combinations(range(len(members)), 2)]))
    T.give_back()
    return model


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [t or "" for t in batch.column("text").to_pylist()]
            size, lo = 0, 0
            language: list[str] = [UNKNOWN] * len(text)
            score = np.zeros(len(text))
            for hi in range(1, len(text) + 1):
                size += len(text[hi - 1])
                if hi < len(text) and hi - lo < BLOCK_ROWS and size < T.BLOCK_BYTES:
                    continue
                lowered = [t.lower() for t in text[lo:hi]]
                ok = np.flatnonzero(_has_letter(lowered))
                if model is not None and len(ok):
                    found, sure = model.predict(features(lowered)[ok])
                    for k, x, s in zip(ok.tolist(), found, sure):
                        language[lo + k], score[lo + k] = x, s
                size, lo = 0, hi
            names = [c for c in batch.schema.names if not c.startswith("__lang")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(language, pa.string()), pa.array(score)],
                names=[*names, "__lang_pred", "__lang_score"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with __lang_pred and __lang_score."""
    schema = docs.select("*", F.lit("").alias("__lang_pred"), F.lit(0.0).alias("__lang_score")).schema
    return docs.mapInArrow(T.tidied(_predict(model)), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    only = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    return predict(only.drop("lang"), fit(only)).select(
        "doc_id", held_out().alias("held_out"), F.col("__lang_pred").alias("lang_pred"),
        F.col("__lang_score").alias("score"))


def accepted(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose language is known (not ``und``) with at least ``least_score``."""
    return under_plain_names({"doc_id", "text", "lang"}, lambda d: _accepted(d, least_score), docs)


def _accepted(docs: DataFrame, least_score: float) -> DataFrame:
    return predict(docs, fit(docs)).filter(
        (F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_score") >= least_score)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
