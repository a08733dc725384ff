"""Language identification, hierarchical: the family first, then one against one.

Features are hashed byte 1- to 3-grams of the lower-cased text, as square roots of
counts with unit length. A linear support vector machine for each family, against
all others, picks the family; within it a linear machine for each pair of languages
votes, and summed margins break ties. The machines are fitted on a bounded sample
of labelled rows, ``SAMPLE`` a language at most; every whole text is predicted.

Defined results: texts null or without a letter get ``und`` and score 0; with no
labelled rows at all every text gets ``und``; ties go to the alphabetically first
name; repeated rows are repeated; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, powers, slices, utf8

DIMS = 1 << 12
SAMPLE = 500  # labelled rows of a language that are fitted on
SAMPLE_BYTES = 1 << 16  # longer texts are not fitted on, where shorter ones do

#: Families of common language codes. A code that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn mr ne gu pa",
    "semitic": "ar he am mt",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def has_letter(text: str) -> bool:
    return any(ch.isalpha() or unicodedata.category(ch)[0] == "L" for ch in text)


def features(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """A row of unit length for each text."""
    raw, offsets = utf8(pa.array([t.lower() for t in texts], pa.large_string()))
    counts = np.zeros((len(texts), dims), np.float32)
    if not len(raw):
        return counts
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    h, base = np.zeros(len(raw), np.uint64), powers(4)[1]
    letters = raw.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(texts) * dims, np.int64)
    for n in range(1, 4):
        if len(raw) < n:
            break
        h = h[:len(raw) - n + 1] * base + letters[n - 1:]
        same = row[:len(h)] == row[n - 1:]
        at = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - (dims.bit_length() - 1))
        total += np.bincount(row[:len(h)][same] * dims + at[same].astype(np.int64), minlength=len(total))
    counts = np.sqrt(total.reshape(len(texts), dims)).astype(np.float32)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


def fit(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """A linear support vector machine (hinge loss) by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    norm = (x * x).sum(1)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(0)
    cost = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum())) * c  # classes weigh the same
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


class Model:
    """``families``: names in order, with a column of ``family_w`` each; ``pairs``: weights by two languages."""

    def __init__(self, x: np.ndarray, langs: list[str], family=FAMILY) -> None:
        of = np.array([family.get(v, v) for v in langs])
        y = np.array(langs)
        self.families = sorted(set(of.tolist()))
        self.members = {f: sorted(set(y[of == f].tolist())) for f in self.families}
        self.family_w = [fit(x, np.where(of == f, 1, -1)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                own = (y == a) | (y == b)
                self.pairs[a, b] = fit(x[own], np.where(y[own] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return ["und"] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        sure = lambda m: 1 / (1 + np.exp(-3 * np.clip(m, -10, 10)))
        chosen, score = np.zeros(len(x), np.int64), np.ones(len(x))
        if self.family_w:
            margins = x @ np.array(self.family_w).T
            chosen, score = margins.argmax(1), sure(margins.max(1))
        out = np.empty(len(x), object)
        for k, f in enumerate(self.families):
            own = np.flatnonzero(chosen == k)
            names = self.members[f]
            votes = np.zeros((len(own), len(names)))
            worst = np.full((len(own), len(names)), 10.0)
            for (i, a), (j, b) in combinations(enumerate(names), 2):
                m = x[own] @ self.pairs[a, b]
                votes[:, i] += (m >= 0) + np.tanh(m) * 1e-3
                votes[:, j] += (m < 0) - np.tanh(m) * 1e-3
                worst[:, i], worst[:, j] = np.minimum(worst[:, i], m), np.minimum(worst[:, j], -m)
            best = votes.argmax(1)
            out[own] = np.array(names, object)[best]
            if len(names) > 1:
                score[own] *= sure(worst[np.arange(len(own)), best])
        return out.tolist(), score


def sample(labelled: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` rows (lang, text) a language, picked by a hash. Thinned first, ranked after."""
    rows = labelled.select("lang", "text", F.xxhash64("text", F.coalesce(F.col("doc_id"), F.lit(0)), F.lit("sample")).alias("h")).where("lang is not null and text is not null")
    few = rows.withColumn("big", (F.octet_length("text") > SAMPLE_BYTES).cast("int"))
    counts = few.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("big")).alias("small"))
    share = F.lit(4.0 * most) / F.greatest(F.when(F.col("small") > 2 * most, F.col("small")).otherwise(F.col("n")), F.lit(1))
    kept = few.join(F.broadcast(counts), "lang").where((F.col("small") <= 2 * most) | (F.col("big") == 0))  # a row a language
    kept = kept.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("big", "h", "text"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "text")


def train(labelled: DataFrame, most: int = SAMPLE, dims: int = DIMS) -> Model:
    """A model from columns lang and text; the sample's feature rows are computed on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 21):
            texts = batch.column("text").to_pylist()
            own = [i for i, t in enumerate(texts) if has_letter(t)]
            x = features([texts[i] for i in own], dims)
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(own, pa.int64())), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], names=["lang", "x"])

    rows = sorted((r.lang, bytes(r.x)) for r in arrow(sample(labelled, most), run, "lang string, x binary").collect())  # ``most`` a language
    x = np.array([np.frombuffer(b, np.float16) for _, b in rows], np.float32).reshape(len(rows), dims)
    return Model(x, [v for v, _ in rows])


def annotate(docs: DataFrame, model: Model, out: str = "langid", dims: int = DIMS) -> DataFrame:
    """``docs`` with a struct ``out`` of lang_pred, score and has_letter, of every whole text.

    Without a letter, or where no language was learned, lang_pred is ``und``; ``und`` may also be a learned label."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # as large as its weights
    rows = docs.select([c for c in docs.columns if c != out])
    found = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("has_letter", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 21):
            texts = batch.column("text").fill_null("").to_pylist()
            own = [i for i, t in enumerate(texts) if has_letter(t)]
            names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            for i in range(0, len(own), 1024):
                some = own[i:i + 1024]
                names[some], score[some] = held.value.predict(features([texts[j] for j in some], dims))
            lettered = np.zeros(len(texts), bool)
            lettered[own] = True
            said = pa.StructArray.from_arrays([pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(lettered)], ["lang_pred", "score", "has_letter"])
            yield pa.RecordBatch.from_arrays([*batch.columns, said], names=[*batch.schema.names, out])

    return arrow(rows, run, T.StructType([*rows.schema.fields, T.StructField(out, found)]))


def predict(docs: DataFrame, model: Model, dims: int = DIMS) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    return annotate(docs.select("doc_id", "text"), model, dims=dims).select("doc_id", "langid.lang_pred", "langid.score")


def held_out(doc_id="doc_id", parts: int = 4, part: int = 2):
    """Whether crc32(doc_id as text) leaves ``part`` by ``parts``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))
