"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

A document is as toxic as its worst sentence, and a sentence as its worst segment. Segments of a sentence are its words
(what stands between white space, lower-cased, with everything but letters taken out, so that i.d-i0ot
compares as letters), two neighbouring words of at most SPLIT letters each read as one, with a margin that is
JOINED less, since such pairs are often innocent, and runs of four or more one-letter words read as one. No segment crosses a sentence, so a text's score depends on that text alone. Two segments compare by the
gapped subsequence kernel: all subsequences of three characters (segment ends included) that span at most five,
each weighted by DECAY for every character skipped, normalised. An inserted character or a gap therefore keeps
most of the similarity.

Training, on the driver, takes a bounded sample: up to SAMPLE documents of each label, the first by a hash of
doc_id, and of a document of more than SAMPLE_CHARS characters the sentences that a hash picks, about so many
characters of them. Instances are sentences, each through its worst segment; equal ones count once. Sentences of clean documents are
negative. Labels mark documents, so which sentences of a toxic document are toxic is found in rounds: at first those
that hold a seed, a segment that stands in toxic documents more often than chance allows (binomial test, false
discovery rate FALSE_SEEDS); after each fit also the worst sentence of each toxic document, if it looks toxic and no clean
document holds its worst segment. Disguises of the marking segments, with a letter put in or doubled, are learned with
them. A logistic curve turns a document's worst margin into the score.

The machine's value of a segment is linear in the segment's subsequences, so landmarks and weights collapse into
one table of subsequence weights; each distinct segment is scored once a worker and kept up to a bound. Scoring is
a narrow step without a shuffle, linear in the text's length.

Edge cases: a null, empty or letterless text has the score of the smallest margin. Without two labels to learn
from every score is 0. Labels of unknown documents, null labels and null ids are not used; of repeated labels
of one document the largest counts. Repeated rows get equal results. Bytes that aren't UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, linear, pretoken, shared

SAMPLE = 1500
LANDMARKS = 256
ROUNDS = 5
#: Characters read of a document of the sample, about.
SAMPLE_CHARS = 1 << 16
#: The share of seeds that may mark toxic sentences by chance, and the least number of documents of a seed.
FALSE_SEEDS, SEED_DOCS = 0.01, 4
#: Letters of neighbouring words that are read as one as well, if they have JOIN together, at JOINED less.
SPLIT, JOIN, JOINED = 4, 5, 0.5
DECAY = 0.5
SPAN = 5
THRESHOLD = 0.3
#: Rows scored at once.
ROWS = 512
#: Longer segments are read by their overlapping parts of this length.
PART = 32
_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _letters(chars: np.ndarray) -> np.ndarray:
    """Codes 1 to 62 of letters: a-z and the commonest accents apart, others folded together."""
    code = np.where((chars >= 97) & (chars <= 122), chars - 96, 27 + (chars * np.uint32(2654435761) >> np.uint32(20)) % np.uint32(36))
    return code.astype(np.uint8)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of the words given as letter codes; weights of a word have norm 1."""
    gap = b"\x3f" + bytes(SPAN)  # an end, 63, and room that no subsequence spans
    flat = np.frombuffer(b"".join(b"\x3f" + w + gap for w in words), np.uint8).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2 + SPAN
    word = np.repeat(np.arange(len(words)), size)
    rows, subs, weights = [], [], []
    at = np.flatnonzero(flat > 0)
    for a, b in _STEPS:
        ok = at[(at + b < len(flat))]
        ok = ok[(flat[ok + a] > 0) & (flat[ok + b] > 0)]
        rows.append(word[ok])
        subs.append((flat[ok] << 12) | (flat[ok + a] << 6) | flat[ok + b])
        weights.append(np.full(len(ok), DECAY ** (b - 2)))
    row, sub, weight = np.concatenate(rows), np.concatenate(subs), np.concatenate(weights)
    key, inverse = np.unique(row << 18 | sub, return_inverse=True)
    total = np.bincount(inverse, weight, len(key))
    row, sub = key >> 18, key & 0x3FFFF
    norm = np.sqrt(np.bincount(row, total * total, len(words)))
    return row, sub, total / np.maximum(norm[row], 1e-12)


def kernel(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    row, sub, weight = features(landmarks)
    held, column = np.unique(sub, return_inverse=True)
    table = np.zeros((len(held), len(landmarks)), np.float32)
    table[column, row] = weight
    out = np.zeros((len(words), len(landmarks)))
    for i in range(0, len(words), 500):
        row, sub, weight = features(words[i : i + 500])
        at = np.minimum(np.searchsorted(held, sub), len(held) - 1)
        row, at, weight = (x[held[at] == sub] for x in (row, at, weight))
        np.add.at(out, row + i, weight[:, None] * table[at])
    return out


def segments_of(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices (i, j, codes, starts, ends, text, sentence, joined) of texts: the segments' letters, spans, texts and sentences, and which are two words."""
    lower = [t.lower() if t else t for t in texts]
    for i, j, chars, offs in pretoken.texts_as_chars(lower, arrays.SLICE_BYTES // 8):
        kind = pretoken.classes()[chars] if len(chars) else np.zeros(0, np.uint8)
        letter, space = kind == 1, kind == 0
        edge = np.zeros(len(chars) + 1, bool)
        edge[offs] = True
        token = np.cumsum(space | edge[:-1])  # letters with one number make a word
        stop = np.cumsum(np.isin(chars, [ord(c) for c in ".!?\n"]) | edge[:-1])
        at = np.flatnonzero(letter)
        codes, token = _letters(chars[at]), token[at]
        head = np.concatenate([[True], token[1:] != token[:-1]])[: len(at)]
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(at))[: len(starts)]
        sentence = _sentences(token[starts], stop[at[starts]], stop[at[ends - 1]])
        owner = np.arange(len(starts))  # the word whose text and sentence a segment has
        parts = [(starts, ends, owner)]
        size = ends - starts
        next_ = np.concatenate([sentence[1:] == sentence[:-1], [False]])[: len(starts)]
        # Neighbouring short words, and runs of one-letter words.
        after = np.append(size[1:], 0)[: len(size)]
        first = np.flatnonzero(next_ & (size <= SPLIT) & (after <= SPLIT) & (size + after >= JOIN))
        parts.append((starts[first], ends[np.minimum(first + 1, len(ends) - 1)], first))
        single = np.flatnonzero(size == 1)
        if len(single) > 3:
            new = np.ones(len(single), bool)
            new[1:] = (np.diff(single) != 1) | ~next_[single[:-1]]
            run = np.flatnonzero(new)
            length = np.diff(run, append=len(single))
            run, length = run[length > 3], length[length > 3]
            parts.append((starts[single[run]], ends[single[run + length - 1]], single[run]))
        joined = np.repeat(np.arange(len(parts)) == 1, [len(p[2]) for p in parts])
        starts, ends, owner = (np.concatenate(c) for c in zip(*parts, strict=True))
        # Long segments by overlapping parts.
        half = PART // 2
        many = np.maximum(1, -(-(ends - starts - PART) // half) + 1)
        place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        stop_at, owner, joined = np.repeat(ends, many), np.repeat(owner, many), np.repeat(joined, many)
        starts = np.repeat(starts, many) + half * place
        ends = np.minimum(starts + PART, stop_at)
        text = np.searchsorted(offs, at[parts[0][0]], "right") - 1
        yield i, j, codes, starts, ends, text[owner], sentence[owner], joined


def _sentences(token: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sentence numbers of words, of which a word with stops inside, such as i.d.i.o.t, belongs to that of its first letter."""
    out = np.zeros(len(token), np.int64)
    if len(token):
        out[1:] = np.cumsum(first[1:] != last[:-1])
    return out


def _variants(word: bytes, rng: np.random.Generator) -> list[bytes]:
    """Disguises to learn as well, of words of five letters or more: a letter put in, and a letter doubled."""
    if len(word) < 5:
        return []
    put = rng.integers(1, len(word), 4).tolist()
    return [word[:k] + bytes([rng.integers(1, 27)]) + word[k:] for k in put[:3]] + [word[: put[3]] + word[put[3] :][:1] + word[put[3] :]]


def _without_copies(owner: np.ndarray, sentence: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The rows (text, sentence, segment) of texts that don't share half of their sentences with texts before them."""
    order = np.argsort(sentence, kind="stable")
    heads = np.flatnonzero(np.diff(sentence[order], prepend=-1))
    print_ = np.add.reduceat(arrays.mix(key[order]), heads)  # a sentence by its segments
    of = owner[order][heads]
    known: set[int] = set()
    copies = []
    for text in np.unique(of).tolist():
        own = set(print_[np.searchsorted(of, text) : np.searchsorted(of, text, "right")].tolist())
        if 2 * len(own & known) >= len(own):
            copies.append(text)
        else:
            known |= own
    return ~np.isin(owner, copies)


def _seeds(bad: np.ndarray, good: np.ndarray, share: float, fit: np.ndarray) -> np.ndarray:
    """Segments whose documents are toxic too often for chance: a binomial test each, all by Benjamini and Hochberg's rule."""
    some = np.flatnonzero((bad + good >= SEED_DOCS) & fit)
    n, k = (bad + good)[some].astype(int), bad[some].astype(int)
    longest = int(n.max(initial=0))
    logs = np.concatenate([[0], np.cumsum(np.log(np.arange(1, longest + 1)))])
    chance = np.zeros(len(some))
    for m in np.unique(n).tolist():
        j = np.arange(m + 1)
        terms = np.exp(logs[m] - logs[j] - logs[m - j] + j * np.log(share) + (m - j) * np.log(1 - share))
        tail = np.cumsum(terms[::-1])[::-1]  # of j toxic documents or more
        chance[n == m] = tail[k[n == m]]
    order = np.argsort(chance, kind="stable")
    passed = np.flatnonzero(chance[order] <= FALSE_SEEDS * (1 + np.arange(len(order))) / max(1, len(order)))
    found = some[order[: passed[-1] + 1]] if len(passed) else some[:0]
    odds = np.log((bad[found] + 0.1) / share) - np.log((good[found] + 0.5) / (1 - share))
    return found[odds > np.log(10)]


class Model:
    def __init__(self, texts: list[str], toxic: list[int], landmarks: int = LANDMARKS):
        self.table, self.bias, self.curve = np.zeros(1 << 18), 0.0, (0.0, -30.0)
        self.held: dict[int, float] = {}  # margins of segments, by hash
        label = np.array(toxic)
        if len(set(toxic)) < 2:
            return
        owner, sentence, key, less, spell, n = [], [], [], [], {}, 0
        for i, _, codes, starts, ends, text, number, joined in segments_of(texts):
            hashes = self._hash(codes, starts, ends)
            _, once = np.unique(hashes ^ arrays.mix(number.astype(np.uint64) + np.uint64(1)), return_index=True)  # words first
            less.append(JOINED * joined[once])
            owner.append(text[once] + i)
            sentence.append(number[once] + n)
            n += int(number.max(initial=-1)) + 1
            key.append(hashes[once])
            letters = codes.tobytes()
            each, at = np.unique(hashes, return_index=True)
            for h, a, b in zip(each.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True):
                spell.setdefault(h, letters[a:b])
        if not owner:
            return
        owner, sentence, key, less = (np.concatenate(c) for c in (owner, sentence, key, less))
        once = _without_copies(owner, sentence, key)
        owner, sentence, key, less = owner[once], sentence[once], key[once], less[once]
        label = np.where(np.isin(np.arange(len(label)), owner), label, -1)
        names, inverse = np.unique(key, return_inverse=True)
        pair = np.unique(owner * len(names) + inverse)  # a document counts once
        bad = np.bincount(pair % len(names), label[pair // len(names)], len(names))
        good = np.bincount(pair % len(names), 1 - label[pair // len(names)], len(names))
        size = np.array([len(spell[int(h)]) for h in names])
        seeds = _seeds(bad, good, (label == 1).sum() / max(1, (label >= 0).sum()), size > 2)
        clean = np.flatnonzero(good > 0)
        if not len(seeds) or not len(clean):
            return
        rng = np.random.default_rng(0)
        top = seeds[np.argsort(-bad[seeds], kind="stable")][: landmarks // 2]
        other = rng.choice(clean, min(len(clean), landmarks // 2), replace=False, p=good[clean] / good[clean].sum())
        marks = [spell[int(names[k])] for k in [*top, *other]]
        square = kernel(marks, marks)
        spread, vector = np.linalg.eigh(square)
        keep = spread > 1e-6
        root = vector[:, keep] / np.sqrt(spread[keep])  # Nystroem: features are kernel(x, marks) @ root
        common = clean[np.argsort(-good[clean], kind="stable")][:3000]
        negative = np.union1d(common, rng.choice(clean, min(len(clean), 3000), replace=False))
        row, sub, weight = features(marks)
        positive = seeds  # sentences that hold a seed, through it
        for _ in range(ROUNDS):
            marking = [spell[int(names[k])] for k in positive]
            marking += [v for w in marking for v in _variants(w, rng)]
            x = np.vstack([kernel(part, marks) @ root for part in (marking, [spell[int(names[k])] for k in negative])])
            y = np.concatenate([np.ones(len(marking)), -np.ones(len(negative))])
            even = np.where(y > 0, 0.5 / len(marking), 0.5 / len(negative))
            w, self.bias = linear.svm(x, y, penalty=20_000.0, rounds=400, weight=even)
            beta = root @ w
            self.table = np.bincount(sub, weight * beta[row], 1 << 18)
            self.held = {}
            margin = self._margins([spell[int(h)] for h in names])
            # Each sentence through its worst segment; of each document the worst sentence.
            value = margin[inverse] - less
            order = np.lexsort((inverse, -value, sentence))
            worst = order[np.concatenate([[True], sentence[order][1:] != sentence[order][:-1]])]
            through, of, value = inverse[worst], owner[worst], value[worst]
            by = np.lexsort((through, -value, of))
            top_of = by[np.concatenate([[True], of[by][1:] != of[by][:-1]])]
            through_top, of_top, top_value = through[top_of], of[top_of], value[top_of]
            witness = through_top[(label[of_top] == 1) & (top_value > 0) & (good[through_top] == 0)]
            positive = np.unique(np.concatenate([seeds, witness]))
            # Hard negatives: the sentences of clean documents that look worst.
            hard = np.unique(through[label[of] == 0])
            hard = hard[np.argsort(-margin[hard], kind="stable")][:2000]
            negative = np.unique(np.concatenate([negative, hard[margin[hard] > -1]]))
        self.curve = linear.logistic(top_value, label[of_top].astype(float))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"held": {}}

    @staticmethod
    def _hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return arrays.span_hash(codes, starts, ends)

    def _margins(self, words: list[bytes]) -> np.ndarray:
        out = []
        for i in range(0, len(words), 2_000):
            row, sub, weight = features(words[i : i + 2_000])
            out.append(np.bincount(row, weight * self.table[sub], len(words[i : i + 2_000])))
        return np.concatenate(out) + self.bias if out else np.zeros(0)

    def margins(self, texts: list[str | None], most: int = 1 << 18) -> np.ndarray:
        """The worst margin of each text; without a segment, the smallest that counts."""
        out = np.full(len(texts), -9.0)
        for i, _, codes, starts, ends, text, _, joined in segments_of(texts):
            if not len(starts):
                continue
            keys, first, inverse = np.unique(self._hash(codes, starts, ends), return_index=True, return_inverse=True)
            if len(self.held) > most:
                self.held = {}
            names = keys.tolist()
            new = [k for k, name in enumerate(names) if name not in self.held]
            letters = codes.tobytes()
            values = self._margins([letters[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            self.held.update(zip((names[k] for k in new), values.tolist(), strict=True))
            value = np.fromiter((self.held[name] for name in names), np.float64, len(names))
            np.maximum.at(out, text + i, value[inverse] - JOINED * joined)
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return linear.sigmoid(self.curve[0] * self.margins(texts) + self.curve[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic): up to sample documents of each label."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The ids of the sample first, from the narrow table; then their texts.
    rows = known.withColumn("h", F.xxhash64(F.col("doc_id").cast("string")))
    top = [rows.filter(F.col("toxic") == k).orderBy("h", "doc_id").limit(sample) for k in (0, 1)]  # each task keeps its own first
    chosen = top[0].union(top[1])
    n = f"cast(ceil(length(text) / {SAMPLE_CHARS}) AS long)"
    pieces = f"filter(split(text, '(?<=[.!?\\n])'), s -> pmod(xxhash64(s), {n}) = 0)"
    read = F.expr(f"if(length(text) <= {SAMPLE_CHARS}, text, left(array_join({pieces}, ''), {2 * SAMPLE_CHARS}))").alias("text")  # of a long text, sentences by hash
    got = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").filter("text IS NOT NULL").select("doc_id", read, "toxic").collect()
    got = sorted({r["text"]: (r["doc_id"], r["text"], r["toxic"]) for r in sorted(got)}.values())  # copies count once
    return Model([t for _, t, _ in got], [x for _, _, x in got])


def score_of(spark: SparkSession, text: F.Column, model: Model) -> F.Column:
    """The score of a text column. Only the texts go to Python, and only scores come back."""
    shared_model = spark.sparkContext.broadcast(model)  # a table of 2**18 weights

    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [shared_model.value.score(arrays.texts(column.slice(k, ROWS))) for k in range(0, len(column), ROWS)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return run(text.cast("string"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a column score."""
    return docs.withColumn("score", score_of(docs.sparkSession, F.col("text"), model))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit_on_tables(spark: SparkSession, sf_dir: str) -> Model:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = shared.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return fit(docs, labels.filter(~held_out()))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the rows that score threshold or more."""
    names = ["text" if c == "text" else f"__tx_{i}" for i, c in enumerate(docs.columns)]  # a column Text is another one
    return docs.toDF(*names).filter(score_of(docs.sparkSession, F.col("text"), model) < threshold).toDF(*docs.columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(docs.withColumn("held_out", held_out()), fit_on_tables(spark, sf_dir))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
