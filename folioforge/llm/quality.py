"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are hashed character trigrams and, as terms of their own, the shapes of its words (capitals,
symbols at the end, repetition of the word before) and the share of distinct words. Counts are dampened,
weighted by rarity and normalised; a truncated singular value decomposition, fitted on the labelled sample,
gives latent vectors. Every document's vector is compared with all labelled ones by exact cosine products, a
block of documents at a time, and its NEIGHBOURS nearest vote with their label by similarity.

The labelled vectors are broadcast; their number is bounded: up to SAMPLE of each label, the first by a hash of
doc_id. Tasks send the sample's terms to the driver, TERMS numbers a document, and no text. Scoring is a narrow
step without a shuffle. Whole texts are read.

Edge cases: a null or empty text has no terms; its score is the labels' share in the sample, as it is where
nothing is similar. Without any label every score is 0.5. Null labels and ids are not used; of repeated labels
of one document the largest counts. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, shared

SAMPLE = 1500
TOPICS = 48
NEIGHBOURS = 15
BLOCK = 256
_TRIGRAMS = 1 << 11
_SHAPES = 64
_SHARES = 32
TERMS = _TRIGRAMS + _SHAPES + _SHARES
#: The weight of shape terms beside trigrams.
_SHAPE_WEIGHT = 4.0


def terms(column: pa.Array) -> np.ndarray:
    """Dampened term frequencies of each text, a row each."""
    buf, offs = arrays.utf8(column)
    out = np.zeros((len(offs) - 1, TERMS), np.float32)
    low = np.arange(256, dtype=np.uint32)
    low[65:91] += 32
    for i, j in arrays.slices(offs):
        part, at = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        code = low[part]
        gram = np.zeros(max(0, len(part) - 2), np.int64)
        if len(part) > 2:
            gram = ((((code[:-2] * np.uint32(65599)) ^ code[1:-1]) * np.uint32(65599)) ^ code[2:]) * np.uint32(2654435761) >> np.uint32(21)
        starts, ends, first = arrays.words(part, at)
        hashes, _ = arrays.word_hashes(part, starts, ends)
        upper = np.concatenate([[0], np.cumsum((part >= 65) & (part <= 90))])
        ups = upper[ends] - upper[starts]
        final = part[ends - 1] if len(ends) else part[:0]
        symbol = ((final < 48) | ((final > 57) & (final < 65)) | ((final > 90) & (final < 97)) | ((final > 122) & (final < 128))) if len(ends) else np.zeros(0, bool)
        second = part[np.maximum(ends - 2, starts)] if len(ends) else part[:0]
        double = symbol & (second == final)
        again = np.zeros(len(starts), bool)
        again[1:] = hashes[1:] == hashes[:-1]
        again[first[:-1][first[:-1] < len(starts)]] = False  # the word before is another text's
        many = np.minimum(ups, 2)
        shape = _TRIGRAMS + (many * 16 + again * 8 + double * 4 + symbol * 2 + (ends - starts > 3)).astype(np.int64)
        for k in range(i, j):
            a, b = at[k - i], max(at[k - i], at[k - i + 1] - 2)
            c, d = first[k - i], first[k - i + 1]
            if d == c:
                continue
            n_gram, n_word = max(1, b - a), d - c
            row = out[k]
            row[:_TRIGRAMS] = np.sqrt(np.bincount(gram[a:b], minlength=_TRIGRAMS)[:_TRIGRAMS] / n_gram)
            row[_TRIGRAMS : _TRIGRAMS + _SHAPES] = _SHAPE_WEIGHT * np.sqrt(np.bincount(shape[c:d] - _TRIGRAMS, minlength=_SHAPES)[:_SHAPES] / n_word)
            # Distinct words against the square root of all words, which lengths have in common.
            share = min(_SHARES - 1, int(4 * len(np.unique(hashes[c:d])) / np.sqrt(n_word)))
            row[_TRIGRAMS + _SHAPES + share] = 1.0
    return out


class Model:
    def __init__(self, x: np.ndarray, quality: list[int]):
        """x has the terms of each labelled text, a row each."""
        self.label = np.array(quality, np.float32)
        self.share = float(self.label.mean()) if quality else 0.5
        if not quality:
            return
        self.rarity = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.2
        x = self._weighted(x)
        size = min(TOPICS, *x.shape)
        # Randomised range finder with power steps.
        probe = x @ np.random.default_rng(0).normal(size=(x.shape[1], size + 8)).astype(np.float32)
        for _ in range(3):
            probe = np.linalg.qr(probe)[0]
            probe = x @ (x.T @ probe)
        base = np.linalg.qr(probe)[0]
        _, _, topics = np.linalg.svd(base.T @ x, full_matrices=False)
        self.topics = np.ascontiguousarray(topics[:size].T)
        self.vectors = np.ascontiguousarray(self._latent(x).T)

    def _weighted(self, x: np.ndarray) -> np.ndarray:
        x = x * self.rarity
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def _latent(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.topics
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.share)
        if not len(self.label):
            return out
        for i in range(0, len(column), BLOCK):
            x = terms(column.slice(i, BLOCK))
            some = np.flatnonzero(x.any(axis=1))
            if not len(some):
                continue
            near = self._latent(self._weighted(x[some])) @ self.vectors
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, 1), 0) ** 4
            total = weight.sum(axis=1)
            vote = (weight * self.label[top]).sum(axis=1)
            out[i + some] = np.where(total > 0, vote / np.maximum(total, 1e-12), self.share)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, quality): up to sample documents of each label."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = known.withColumn("h", F.xxhash64(F.col("doc_id").cast("string")))
    top = [rows.filter(F.col("quality") == k).orderBy("h", "doc_id").limit(sample) for k in (0, 1)]  # each task keeps its own first
    chosen = top[0].union(top[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id").filter("text IS NOT NULL")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                rows = pa.array([x.tobytes() for x in terms(part.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), rows], ["doc_id", "quality", "x"])

    got = texts.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(read, "doc_id long, quality int, x binary").collect()  # 2 * SAMPLE rows of TERMS numbers
    got = sorted({r["doc_id"]: (r["doc_id"], r["x"], r["quality"]) for r in sorted(got)}.values())
    x = np.frombuffer(b"".join(b for _, b, _ in got), np.float32).reshape(-1, TERMS)
    return Model(x, [y for _, _, y in got])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = shared.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, shared.table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held))
    shared_model = spark.sparkContext.broadcast(model)  # 2 * SAMPLE vectors and the topics

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared_model.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())], ["doc_id", "held_out", "score"])

    out = docs.withColumn("held_out", held).select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
