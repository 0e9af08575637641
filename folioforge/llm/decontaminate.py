"""Benchmark decontamination: template canonicalisation and slot consistency.

Tokens are runs of letters or of digits. Numbers, units after a number, and capitalised tokens inside a
sentence become typed placeholders (neighbours of one type are one slot); other tokens are literals in lower
case. Every window of five template tokens with at least three literals is hashed. A capitalised token at a
sentence's start may be a name or not, so a window that holds such tokens is hashed once for each reading that
leaves two literals.

The windows of the benchmark are a table, and so are those of the documents that pass a filter of bits (a
broadcast of FILTER_BITS at most, whatever the benchmark's size; it only saves rows). Both are joined by hash, with the
strategy that Spark picks. Pairs of a document and an item with enough windows are checked slot by slot: on one
diagonal, a value of the item must stand for one value of the document throughout, or the windows with the odd
slot don't count. A document that holds at least half of an item's windows is contaminated, whether its numbers,
names and units are the item's own or others.

Items without any window (under five slots, or of numbers, names and units for the most part) are found where a
document holds their whole token sequence unchanged, whatever stands between the tokens: the first and the last
2**k tokens of the sequence, which together cover it, are joined like windows and must lie on one diagonal.
Re-parameterised they are not found.

Contamination depends on a text alone, so documents are joined by a digest of their text, never by doc_id.

Edge cases: null and empty texts hold nothing. Items under three tokens are never found. Rows that repeat a
doc_id are judged by their own texts; rows that repeat doc_id and text, or item_id and text, count once. Null
doc_id and item_id stay null. Bytes that aren't UTF-8 are read as U+FFFD. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, shared

WINDOW = 5
LITERALS = 3
COVERAGE = 0.5
#: Tokens that an item without windows needs.
EXACT = 3
#: Bits of the filter of benchmark windows, at least and at most, and bits a window in between.
LEAST_BITS, FILTER_BITS, BITS_EACH = 20, 28, 64
#: Units that may follow a number.
UNITS = "mm cm m km mg g kg t ml cl l s ms min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years percent dollars dollar euros euro cents cent pounds pound miles mile feet foot ft inches inch in lb lbs oz kmh mph hz khz mhz ghz w kw mw v kv pa kpa bar j kj cal kcal degrees celsius fahrenheit".split()

_LITERAL, _NUMBER, _NAME, _UNIT = 0, 1, 2, 3
_CODES = arrays.mix(np.array([11, 12, 13, 14], np.uint64))
_KIND = np.zeros(256, np.uint8)  # 0 between tokens, 1 letters, 2 digits
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Templates:
    """The templates of some texts: codes and kinds of their slots, and the n + 1 places of each text's slots."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        kind = _KIND[buf]
        head = np.zeros(len(buf) + 1, bool)
        head[offs] = True
        change = np.ones(len(buf), bool)
        change[1:] = kind[1:] != kind[:-1]
        cut = np.flatnonzero(change | head[:-1])
        ends = np.append(cut[1:], len(buf))
        keep = kind[cut] > 0 if len(cut) else np.zeros(0, bool)
        starts, ends = cut[keep], ends[keep]
        low = _LOWER[buf]
        after = np.zeros(len(buf), bool)  # the second byte of a Latin capital
        after[1:] = buf[:-1] == 0xC3
        accent = after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
        low = np.where(accent, buf + 32, low).astype(np.uint8)
        n = len(starts)
        codes = arrays.word_hashes(low, starts, ends)[0] if n else np.zeros(0, np.uint64)
        kinds = np.zeros(n, np.uint8)
        start = np.zeros(n, bool)
        if n:
            stop = np.isin(buf, np.frombuffer(b".!?\n", np.uint8))
            stops = np.concatenate([[0], np.cumsum(stop)])
            fresh = head[starts]
            fresh[1:] |= stops[starts[1:]] > stops[ends[:-1]]
            first = np.searchsorted(starts, offs)
            fresh[first[:-1][first[:-1] < first[1:]]] = True
            capital = ((buf[starts] >= 65) & (buf[starts] <= 90)) | ((buf[starts] == 0xC3) & accent[np.minimum(starts + 1, len(buf) - 1)])
            big = np.concatenate([[0], np.cumsum((buf != low).astype(np.int64))])
            kinds[capital & ~fresh & (big[ends] - big[starts] == 1)] = _NAME
            number = kind[starts] == 2
            kinds[number] = _NUMBER
            follows = np.concatenate([[False], number[:-1]]) & ~head[starts]
            kinds[follows & np.isin(codes, _unit_codes())] = _UNIT
            start = capital & fresh & (big[ends] - big[starts] == 1) & (kinds == _LITERAL)
        first = np.searchsorted(starts, offs)
        same = np.zeros(n, bool)
        if n:
            same[1:] = (kinds[1:] == kinds[:-1]) & (kinds[1:] != _LITERAL)
            same[first[:-1][first[:-1] < n]] = False
        slot = np.flatnonzero(~same)
        self.kinds = kinds[slot]
        self.fresh = start[slot]  # literals that may be names
        values = arrays.span_hash(codes, slot, np.append(slot[1:], n)) if n else codes
        self.values = values
        self.codes = np.where(self.kinds == _LITERAL, values, _CODES[self.kinds])
        self.first = np.searchsorted(slot, first)
        self.tokens, self.first_token = codes, first

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows with enough literals."""
        at = arrays.window_starts(self.first, WINDOW)
        literal = np.concatenate([[0], np.cumsum(self.kinds == _LITERAL)])
        at = at[literal[at + WINDOW] - literal[at] >= LITERALS]
        return at, arrays.row_hash(self.codes[at[:, None] + np.arange(WINDOW)])

    def readings(self, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """windows(), and once more for each choice of sentence starts read as names that leaves two literals."""
        bits = np.zeros(len(at), np.uint8)
        for p in range(WINDOW):
            bits |= self.fresh[at + p].astype(np.uint8) << p
        some = np.flatnonzero(bits)
        spans = at[some, None] + np.arange(WINDOW)
        literals = (self.kinds[spans] == _LITERAL).sum(axis=1)
        starts, found = [at], [hashes]
        for mask in range(1, 1 << WINDOW):
            read = np.flatnonzero((bits[some] & mask == mask) & (literals - mask.bit_count() >= LITERALS - 1))
            if len(read):
                codes = self.codes[spans[read]]
                codes[:, [p for p in range(WINDOW) if mask >> p & 1]] = _CODES[_NAME]
                starts.append(at[some[read]])
                found.append(arrays.row_hash(codes))
        return np.concatenate(starts), np.concatenate(found)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all runs of so many tokens."""
        at = arrays.window_starts(self.first_token, width)
        return at, arrays.mix(arrays.window_hash(self.tokens, width)[at] + np.uint64(width)) if len(at) else np.zeros(0, np.uint64)


_units: list[np.ndarray] = []


def _unit_codes() -> np.ndarray:
    if not _units:
        buf = np.frombuffer("".join(UNITS).encode(), np.uint8)
        ends = np.cumsum([len(u) for u in UNITS])
        _units.append(arrays.word_hashes(buf, ends - [len(u) for u in UNITS], ends)[0])
    return _units[0]


_WINDOWS = "item_id long, item long, total int, width int, hash long, place int, kinds array<int>, fresh array<boolean>, own array<long>"
_PROBES = "doc_id long, digest string, hash long, at int, here array<long>"
_FOUND = "doc_id long, digest string, item_id long, item long, windows long, coverage double, reparameterised boolean"


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of the rows of a matrix."""
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel(), kind))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of items (item_id, item, text); for an item without any, the runs that cover it (width > 0)."""
    names = [c.split()[0] for c in _WINDOWS.split(", ")]
    for batch in batches:
        buf, offs = arrays.utf8(batch.column("text"))
        of = Templates(buf, offs)
        start, _ = of.windows()
        total = np.bincount(np.searchsorted(of.first, start, "right") - 1, minlength=batch.num_rows)
        at, hashes = of.readings(*of.windows())
        row = np.searchsorted(of.first, at, "right") - 1
        slots = at[:, None] + np.arange(WINDOW)
        columns = [batch.column("item_id").take(pa.array(row)), batch.column("item").take(pa.array(row)), pa.array(total[row], pa.int32()), pa.array(np.zeros(len(row)), pa.int32()), pa.array(hashes.view(np.int64))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(at - of.first[row], pa.int32()), _lists(of.kinds[slots], pa.int32()), _lists(of.fresh[slots], pa.bool_()), _lists(of.values[slots].view(np.int64), pa.int64())], names)
        size = np.diff(of.first_token)
        rows: list[tuple] = []
        for k in np.flatnonzero((total == 0) & (size >= EXACT)).tolist():
            n = int(size[k])
            width = 1 << (n.bit_length() - 1)
            tokens = of.tokens[of.first_token[k] : of.first_token[k] + n]
            hashes = arrays.mix(arrays.window_hash(tokens, width) + np.uint64(width)).view(np.int64)
            for place in sorted({0, n - width}):
                rows.append((batch.column("item_id")[k].as_py(), batch.column("item")[k].as_py(), 1 + (n > width), width, int(hashes[place]), place, [], [], []))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64())], strict=True)], names)


class Filter:
    """Which hashes may be among some windows': two bits a hash."""

    _SHIFTS = (0, 64 - FILTER_BITS)
    _PART = 1 << 12  # bytes of one of Spark's bitmaps

    def __init__(self, windows: DataFrame):
        n, widths = windows.agg(F.count("*"), F.collect_set("width")).first()  # a width is a power of two
        self.widths = sorted(w for w in widths if w)
        self.bits = min(FILTER_BITS, max(LEAST_BITS, (BITS_EACH * n).bit_length()))
        cells = windows.select(F.explode(F.array(*(F.shiftrightunsigned(F.shiftleft("hash", k), 64 - self.bits) + 1 for k in self._SHIFTS))).alias("c"))
        maps = cells.groupBy(F.expr("bitmap_bucket_number(c)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(c))").alias("m")).collect()  # FILTER_BITS at most
        self.set = np.zeros((1 << self.bits) // 8, np.uint8)
        for r in maps:
            self.set[(r["b"] - 1) * self._PART : r["b"] * self._PART] = np.frombuffer(r["m"], np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for k in self._SHIFTS:
            c = (hashes << np.uint64(k)) >> np.uint64(64 - self.bits)
            out &= (self.set[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def _probe(texts: pa.Array, maybe: Filter) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, hashes, places, values of the slots) of the windows and runs of texts that pass the filter."""
    buf, offs = arrays.utf8(texts)
    for i, j in arrays.slices(offs):
        part = Templates(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        at, hashes = part.readings(*part.windows())
        passed = maybe(hashes)
        at, hashes = at[passed], hashes[passed]
        row = np.searchsorted(part.first, at, "right") - 1
        yield i + row, hashes, at - part.first[row], part.values[at[:, None] + np.arange(WINDOW)].view(np.int64)
        for width in maybe.widths:
            at, hashes = part.runs(width)
            passed = maybe(hashes)
            at, hashes = at[passed], hashes[passed]
            row = np.searchsorted(part.first_token, at, "right") - 1
            yield i + row, hashes, at - part.first_token[row], np.zeros((len(at), 0), np.int64)


def consistent(place: np.ndarray, at: np.ndarray, kinds: np.ndarray, fresh: np.ndarray, own: np.ndarray, here: np.ndarray) -> tuple[int, bool]:
    """How many places of an item stand in a document with consistent slots, and whether all slots hold the item's values.

    A row is a pair of equal windows: its place in the item and in the document, and its slots' kinds and values.
    """
    found: set[int] = set()
    same = True
    for diagonal in np.unique(at - place).tolist():
        rows = np.flatnonzero(at - place == diagonal)
        slots: dict[int, tuple[int, int, int]] = {}
        for r in rows.tolist():
            for k in range(WINDOW):
                kind = int(kinds[r, k]) or (_NAME if fresh[r, k] and own[r, k] != here[r, k] else _LITERAL)
                if kind != _LITERAL:
                    slots[int(place[r]) + k] = (kind, int(own[r, k]), int(here[r, k]))
        stands: dict[tuple[int, int], int] = {}
        odd = set()
        for s in sorted(slots):
            kind, value, other = slots[s]
            same &= value == other
            if stands.setdefault((kind, value), other) != other:
                odd.add(s)
        found.update(p for p in place[rows].tolist() if not odd.intersection(range(p, p + WINDOW)))
    return len(found), same


def _judge(hits: pa.Table) -> pa.Table:
    """The verdict on one document and item, from their equal windows: a row, or none."""
    hits = hits.combine_chunks()
    total, width = hits.column("total")[0].as_py(), hits.column("width")[0].as_py()
    place, at = (np.asarray(hits.column(c).combine_chunks()).astype(np.int64) for c in ("place", "at"))
    if width:  # runs that cover an item
        step = at - place
        windows, same = int(any(len(np.unique(place[step == d])) == total for d in np.unique(step).tolist())), True
        total = 1
    else:
        order = np.lexsort((place, at))
        order = order[np.concatenate([[True], (np.diff(at[order]) != 0) | (np.diff(place[order]) != 0)])]  # several readings may agree
        wide = [np.asarray(hits.column(c).combine_chunks().flatten()).reshape(-1, WINDOW)[order] for c in ("kinds", "fresh", "own", "here")]
        windows, same = consistent(place[order], at[order], *wide)
    out = hits.select(["doc_id", "digest", "item_id", "item"]).slice(0, 1 if windows >= COVERAGE * total else 0)
    n = len(out)
    for name, value, kind in (("windows", windows, pa.int64()), ("coverage", windows / total, pa.float64()), ("reparameterised", not same, pa.bool_())):
        out = out.append_column(name, pa.array([value] * n, kind))
    return out


def _digest() -> F.Column:
    return F.sha2(F.col("text").cast("binary"), 256)


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text")
    windows = shared.materialize(items.mapInArrow(_item_windows, _WINDOWS), "item-windows")
    maybe = spark.sparkContext.broadcast(Filter(windows))
    names = [c.split()[0] for c in _PROBES.split(", ")]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, at, here in _probe(batch.column("text"), maybe.value):
                if len(row):
                    of = pa.array(row)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), batch.column("digest").take(of), pa.array(hashes.view(np.int64)), pa.array(at, pa.int32()), _lists(here, pa.int64())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    probes = rows.select("doc_id", _digest().alias("digest"), "text").mapInArrow(probe, _PROBES)
    hits = shared.materialize(probes.join(windows, "hash").drop("hash").distinct(), "window-pairs")  # copies are one
    key = ["doc_id", "digest", "item_id", "item"]
    # Each window has one place, so distinct places are windows; enough of them are needed before slots are checked.
    enough = hits.groupBy(*key).agg(F.size(F.collect_set("place")).alias("n"), F.max("total").alias("m"), F.max("width").alias("w"))
    enough = enough.filter(F.when(F.col("w") > 0, F.col("n") >= F.col("m")).otherwise(F.col("n") >= COVERAGE * F.col("m"))).select(*key)
    both = enough.select(*(F.col(c).alias(f"k_{c}") for c in key))
    on = F.col("digest") == F.col("k_digest")
    for c in ("doc_id", "item_id", "item"):
        on &= F.col(c).eqNullSafe(F.col(f"k_{c}"))
    return hits.join(both, on, "left_semi").groupBy(*key).applyInArrow(_judge, _FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, coverage, reparameterised): a row for each item that a document holds."""
    return _found(docs, benchmark).drop("digest", "item")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs, all columns, without the rows that hold an item."""
    rows = docs.toDF(*("text" if c == "text" else f"__dc_{i}" for i, c in enumerate(docs.columns)))  # a column Text is another one
    gone = shared.materialize(_found(rows.select(F.lit(0).alias("doc_id"), "text"), benchmark).select("digest").distinct(), "contaminated")
    maybe = docs.sparkSession.sparkContext.broadcast(Filter(gone.select(F.xxhash64("digest").alias("hash"), F.lit(0).alias("width"))))

    @F.arrow_udf("boolean")
    def passes(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(maybe.value(np.asarray(column).view(np.uint64)))

    # Only rows that pass the filter of contaminated digests are joined, and shuffled where the join asks for it.
    keyed = rows.withColumn("digest", _digest()).withColumn("maybe", passes(F.xxhash64("digest")))
    rest = keyed.filter("maybe").join(gone, "digest", "left_anti")
    names = rows.columns
    return keyed.filter("NOT maybe").select(*names).unionByName(rest.select(*names)).toDF(*docs.columns)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), shared.table(spark, sf_dir, "benchmark"))
