"""Language ID: family first, then one-versus-one linear support vector machines inside the family.

Features are hashed character n-grams (1 to 3) of the lower-cased text, in which every run of other characters
than letters is a space; a document's vector holds each bucket's share of its n-grams. Families are told
apart by one-versus-one machines too. The models are fitted on the driver on a bounded sample: up to
SAMPLE whole documents of each language, the first by a hash of doc_id, of which tasks send the vectors. Scoring reads n-grams once, with one
weight table for all machines, and is a narrow step without a shuffle.

Edge cases: a null text, or one without a letter, is `und` with score 0, as is everything if nothing could be
learned. Rows with a null lang or doc_id are not learned from. Repeated rows get equal results.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm import arrays, linear, pretoken, shared

BUCKETS = 1 << 13
SAMPLE = 400
#: Families of languages; one that isn't named is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz",
    "indic": "hi ur bn pa mr gu ne",
    "celtic": "ga gd cy br",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_GRAM = [np.uint64(0x100000001B3), np.uint64(0x9E3779B1), np.uint64(0x85EBCA77)]


def grams(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (i, j, buckets, first): the n-gram buckets of texts i to j, and the places of each text's."""
    lower = [t.lower() if t else t for t in texts]
    for i, j, chars, offs in pretoken.texts_as_chars(lower, arrays.SLICE_BYTES // 2):
        letter = pretoken.classes()[chars] == 1 if len(chars) else np.zeros(0, bool)
        before = np.concatenate([[False], letter[:-1]])[: len(letter)]
        before[offs[:-1][offs[:-1] < len(letter)]] = False
        keep = letter | before  # a letter, or the first of what follows one
        code = np.where(letter, chars, 32)[keep].astype(np.uint64) + np.uint64(1)
        first = np.concatenate([[0], np.cumsum(keep)])[offs]
        doc = np.repeat(np.arange(j - i), np.diff(first))
        parts, docs = [], []
        for n in (1, 2, 3):
            m = len(code) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ code[k : k + m]) * _GRAM[k]
            whole = doc[:m] == doc[n - 1 :]
            parts.append((arrays.mix(h[whole]) & np.uint64(BUCKETS - 1)).astype(np.int64))
            docs.append(doc[:m][whole])
        buckets, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parts, docs))
        order = np.argsort(doc, kind="stable")
        yield i, j, buckets[order], np.searchsorted(doc[order], np.arange(j - i + 1))


def vectors(texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, j, buckets, first in grams(texts):
        for k in range(j - i):
            own = buckets[first[k] : first[k + 1]]
            if len(own):
                out[i + k] = np.bincount(own, minlength=BUCKETS) / len(own)
    return out


def sparse(texts: list[str | None]) -> list[bytes]:
    """The vector of each text as its buckets (u16) and their shares (f32)."""
    out = []
    for row in (vectors(texts[i : i + 256]) for i in range(0, len(texts), 256)):
        for x in row:
            held = np.flatnonzero(x)
            out.append(held.astype(np.uint16).tobytes() + x[held].tobytes())
    return out


class Model:
    """Machines (group a, group b) for families and, inside each, for languages; all weights in one table."""

    def __init__(self, rows: list[bytes], langs: list[str]):
        """rows are vectors as sparse() gives them."""
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for k, row in enumerate(rows):
            n = len(row) // 6
            x[k, np.frombuffer(row, np.uint16, n)] = np.frombuffer(row[2 * n :], np.float32)
        spread = x.std(axis=0) if len(x) else np.ones(BUCKETS)
        scale = (1 / (spread + 1e-4) / np.sqrt(BUCKETS)).astype(np.float32)
        x *= scale
        lang = np.array(langs)
        family = np.array([_FAMILY.get(c, c) for c in langs])
        self.families = sorted(set(family.tolist()))
        self.langs = {f: sorted(set(lang[family == f].tolist())) for f in self.families}
        self.machines: list[tuple[str, str]] = []
        weights, self.bias = [], []
        for names, of in [(self.families, family), *((self.langs[f], lang) for f in self.families)]:
            for a, b in itertools.combinations(names, 2):
                rows = (of == a) | (of == b)
                y = np.where(of[rows] == a, 1.0, -1.0)
                even = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum())  # both sides count alike
                w, bias = linear.svm(x[rows], y, penalty=1000.0, weight=even)
                self.machines.append((a, b))
                weights.append(w * scale)
                self.bias.append(bias)
        self.table = np.array(weights).reshape(len(weights), BUCKETS).T.astype(np.float32)

    def _choose(self, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the name with most votes (by summed confidence on ties), and its confidence."""
        votes = np.zeros((len(margins), len(names)))
        trust = np.zeros((len(margins), len(names)))
        for k, (a, b) in enumerate(self.machines):
            if a in names and b in names:
                p = linear.sigmoid(3 * margins[:, k])
                ia, ib = names.index(a), names.index(b)
                votes[:, ia] += p >= 0.5
                votes[:, ib] += p < 0.5
                trust[:, ia] += p
                trust[:, ib] += 1 - p
        best = np.argmax(votes + trust / (len(names) + 1), axis=1)
        return best, trust[np.arange(len(best)), best] / max(1, len(names) - 1) if len(names) > 1 else np.ones(len(best))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names = ["und"] * len(texts)
        score = np.zeros(len(texts))
        for i, j, buckets, first in grams(texts):
            n = np.diff(first)
            margins = np.zeros((j - i, len(self.machines)))
            full = np.flatnonzero(n)
            if not len(full) or not self.families:
                continue
            if self.machines and len(buckets):
                margins[full] = np.add.reduceat(self.table[buckets], first[:-1][full], axis=0) / n[full, None]
                margins += self.bias
            family, sure = self._choose(self.families, margins)
            for f, name in enumerate(self.families):
                rows = full[family[full] == f]
                if len(rows):
                    best, inside = self._choose(self.langs[name], margins[rows])
                    for r, b, p in zip(rows, best, inside * sure[rows], strict=True):
                        names[i + r], score[i + r] = self.langs[name][b], p
        return names, np.clip(score, 0, 1)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text, lang): up to sample rows of each language."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("lang", "doc_id", F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string")), 1).alias("u"))
    # Only rows whose hash can be among the first of their language are ranked.
    share = rows.groupBy("lang").agg((F.lit(3.0 * sample + 100) / F.count("*") * float(1 << 63)).alias("top"))
    low = rows.join(F.broadcast(share), "lang").filter("u < top")  # a row a language
    first = low.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("u", "doc_id"))).filter(F.col("r") <= sample)
    chosen = F.broadcast(first.select("doc_id").distinct())  # sample ids a language at most
    texts = docs.filter("text IS NOT NULL AND lang IS NOT NULL").join(chosen, "doc_id").select("lang", F.col("text").cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(sparse(arrays.texts(part.column("text"))), pa.binary())], ["lang", "x"])

    got = sorted((r["lang"], bytes(r["x"])) for r in texts.mapInArrow(read, "lang string, x binary").collect())  # the sample, BUCKETS numbers a row at most
    return Model([x for _, x in got], [c for c, _ in got])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs (doc_id, held_out, text)."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights a pair of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = shared_model.value.predict(arrays.texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
    return predict(docs, fit(docs.filter("NOT held_out")))
