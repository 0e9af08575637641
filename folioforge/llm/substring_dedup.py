"""Substring dedup: fixed-block anchors, probed by every rolling window, extended to maximal exact repeats.

Words are runs of bytes other than ASCII white space. A window is `width` consecutive words of one document;
every word covered by a window whose word sequence also starts earlier (smaller doc_id, or the same document
and an earlier start) is removed. Windows are judged on the input.

Method. Each document's non-overlapping blocks of width / 2 words are the reference index; any window holds a
whole block of the document where it first stands. Documents are dealt into chunks of bounded size by a hash.
1. Probe: each chunk sends the sorted distinct hashes of all its rolling block-long windows, marked where one
   is a reference block, to ranges of the hash space; a range answers with the hashes that stand on a
   reference block and occur more than once.
2. Extend: around each hit a chunk forms the full windows that hold it and sends their 128-bit hashes with
   the earliest place of each in the chunk; a range answers with those whose first place is elsewhere.
3. Merge: later windows that touch or overlap are merged into maximal repeats, and their words go.

No pairs are formed, so a passage that a third of the documents hold costs one entry a chunk and hash. Hash
ranges and chunks hold a bounded number of entries at any input size: their numbers follow the input. A passage
that every chunk holds would still grow a range with the number of chunks, so chunks are dealt to salts of SALT_CHUNKS
chunks each: a range is reduced a salt at a time, the salts' results are reduced once more, and each salt then
answers its own chunks. With one salt the second level would change nothing and is left out.
The text is compressed and shuffled once; the three passes read the same exchange. Probe hashes are cut to a
length that follows the input, which can only add windows to step 2. All 128 bits of step 2 decide equality, in
the answers and in the merge; words are hashed to 128 bits without any sum or power that crafted words could cancel.

Edge cases: a null or empty text has no words and stays as it is (kept text ''). A null doc_id counts as the
smallest one; such rows are dealt out by their text. Rows that repeat a doc_id are separate rows; equal starts in
them are the same place, and neither counts as earlier. Bytes that aren't UTF-8 are read as U+FFFD. Other columns
of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, shared

WIDTH = 20
#: Bytes of text in a chunk, and windows in a range of the hash space, on average.
CHUNK_BYTES = 2 << 20
RANGE_WINDOWS = 1 << 20
#: Chunks that one task of a range reads at most, on average.
SALT_CHUNKS = 4096
_NULL_ID = -(1 << 63)
#: Bits of a probe's hash beyond those that number all windows: chance hits are rarer than one in 2**14 windows.
_SPARE_BITS = 14

_PROBES = "r long, salt long, chunk long, n long, keys binary, marks binary"
_HITS = "r long, chunk long, n long, keys binary"
_FULL = "r long, salt long, chunk long, n long, hashes binary, places binary"
_LATER = "r long, chunk long, n long, hashes binary"
RESULT = "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:long,end:long>>"


def _pack(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as steps, in as many byte planes as the longest takes; the upper planes, which are mostly zeros, deflated."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = (int(steps[1:].max(initial=0)).bit_length() + 7) // 8
    plain = max(0, used - 2)
    return keys[:1].astype("<u8").tobytes() + bytes([used]) + planes[:plain].tobytes() + zlib.compress(planes[plain:used].tobytes(), 1)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    used = blob[8]
    plain = max(0, used - 2)
    planes = np.zeros((8, n - 1), np.uint8)
    at = 9 + plain * (n - 1)
    planes[:plain] = np.frombuffer(blob[9:at], np.uint8).reshape(plain, n - 1)
    planes[plain:used] = np.frombuffer(zlib.decompress(blob[at:]), np.uint8).reshape(used - plain, n - 1)
    steps = np.ascontiguousarray(planes.T).view("<u8").reshape(-1)
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<u8", 1), steps]), dtype=np.uint64)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, kinds[t]) for (n, t), c in zip(names, columns, strict=True)})


def _union(rows: pa.Table) -> np.ndarray:
    """All keys of the answers, sorted and distinct."""
    blobs = [_unpack(b, n) for b, n in zip(rows.column("keys").to_pylist(), rows.column("n").to_pylist(), strict=True)]
    return np.unique(np.concatenate(blobs)) if blobs else np.zeros(0, np.uint64)


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which keys stand in the sorted array."""
    if not len(of):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(of, keys)
    at[at == len(of)] = 0
    return of[at] == keys


def _find(h: np.ndarray, g: np.ndarray, of_h: np.ndarray, of_g: np.ndarray) -> np.ndarray:
    """The place of each pair (h, g) among the sorted distinct pairs, -1 where there is none."""
    out = np.full(len(h), -1)
    left, at = np.arange(len(h)), np.searchsorted(of_h, h)
    while len(left):  # as often as pairs share an h, which is once
        inside = at < len(of_h)
        left, at = left[inside], at[inside]
        inside = of_h[at] == h[left]
        left, at = left[inside], at[inside]
        hit = of_g[at] == g[left]
        out[left[hit]] = at[hit]
        left, at = left[~hit], at[~hit] + 1
    return out


class _Chunk:
    """The words of a chunk's documents as hashes; first has the n + 1 places of each document's words."""

    def __init__(self, docs: pa.Table, width: int, bits: int = 64):
        self.ids = np.asarray(docs.column("d").combine_chunks())
        texts = [pa.decompress(z, n, "zstd", asbytes=True) for z, n in zip(docs.column("z").to_pylist(), docs.column("n_bytes").to_pylist(), strict=True)]
        self.column = pa.array(texts, pa.large_binary())
        buf, offs = arrays.utf8(self.column)
        hashes, checks, counts = [], [], []
        for i, j in arrays.slices(offs):
            part, at = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            starts, ends, first = arrays.words(part, at)
            h, g = arrays.word_hashes(part, starts, ends)
            hashes.append(h)
            checks.append(g)
            counts.append(np.diff(first))
        self.words, self.checks = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hashes, checks))
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        self.width, self.block, self.bits = width, width // 2, bits

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, "right") - 1

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and cut hashes of all block-long windows of documents that hold a full window."""
        at = arrays.window_starts(self.first, self.block)
        at = at[np.diff(self.first)[self.doc_of(at)] >= self.width]
        return at, (arrays.window_hash(self.words, self.block)[at] if len(at) else np.zeros(0, np.uint64)) >> np.uint64(64 - self.bits)

    def windows(self) -> np.ndarray:
        return arrays.window_starts(self.first, self.width)

    def full(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of hash of the windows at these places."""
        return arrays.window_hash(self.words, self.width)[at], arrays.window_hash(self.checks, self.width)[at]


def _ranges(keys: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The range, of n, of sorted keys of so many bits: it rises with the key."""
    top = min(bits, 38)
    return ((keys >> np.uint64(bits - top)) * np.uint64(n)) >> np.uint64(top)


def _cuts(r: np.ndarray) -> list[tuple[int, int]]:
    at = np.flatnonzero(np.diff(r)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(r)], strict=True)) if len(r) else []


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, before they are dealt out."""
    for batch in batches:
        texts = [(t or "").encode() for t in arrays.texts(batch.column("text"))]
        z = pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("chunk"), z, pa.array(list(map(len, texts)), pa.int64())], ["d", "chunk", "z", "n_bytes"])


def _groups(same: np.ndarray) -> np.ndarray:
    """Starts of the groups of one or more sorted entries; same: which entries equal the one before."""
    return np.flatnonzero(np.concatenate([[True], ~same]))


def _probe(width: int, n_ranges: int, n_salts: int, bits: int, docs: pa.Table) -> pa.Table:
    chunk = _Chunk(docs, width, bits)
    at, keys = chunk.blocks()
    rows: list[tuple] = []
    if len(at):
        number = docs.column("chunk")[0].as_py()
        block = (at - chunk.first[chunk.doc_of(at)]) % chunk.block == 0
        order = np.argsort(keys, kind="stable")
        keys, block = keys[order], block[order]
        heads = _groups(keys[1:] == keys[:-1])
        marks = np.logical_or.reduceat(block, heads).astype(np.uint8) + 2 * (np.diff(heads, append=len(keys)) > 1).astype(np.uint8)
        keys = keys[heads]
        r = _ranges(keys, bits, n_ranges)
        for i, j in _cuts(r):
            rows.append((int(r[i]), number % n_salts, number, j - i, _pack(keys[i:j]), _bits(marks[i:j])))
    return _table(rows, _PROBES)


def _bits(marks: np.ndarray) -> bytes:
    return np.packbits(np.concatenate([marks & 1, marks >> 1])).tobytes()


def _answer(r: int, chunks: list[int], source: np.ndarray, keys: np.ndarray) -> pa.Table:
    """A row for each source: its keys, sorted and distinct."""
    rows = []
    order = np.lexsort((keys, source))
    source, keys = source[order], keys[order]
    for i, j in _cuts(source):
        each = np.unique(keys[i:j])
        rows.append((r, chunks[int(source[i])], len(each), _pack(each)))
    return _table(rows, _HITS)


def _probed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sources, marks, starts of equal keys, their numbers), sorted by key."""
    keys, marks = [], []
    for n, blob, mark in zip(rows.column("n").to_pylist(), rows.column("keys").to_pylist(), rows.column("marks").to_pylist(), strict=True):
        keys.append(_unpack(blob, n))
        bits = np.unpackbits(np.frombuffer(mark, np.uint8), count=2 * n)
        marks.append(bits[:n] + 2 * bits[n:])
    source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key, mark = np.concatenate(keys), np.concatenate(marks)
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = _groups(key[1:] == key[:-1])
    size = np.diff(heads, append=len(key))
    mark = np.bitwise_or.reduceat(mark[order], heads) | 2 * (size > 1).astype(np.uint8)
    return key, source[order], mark, heads, size


def _hits(rows: pa.Table) -> pa.Table:
    key, source, mark, _, size = _probed(rows)
    hit = np.repeat(mark == 3, size)
    return _answer(rows.column("r")[0].as_py(), rows.column("chunk").to_pylist(), source[hit], key[hit])


def _probed_salt(rows: pa.Table) -> pa.Table:
    """The probes of a salt's chunks as if it were one chunk."""
    key, _, mark, heads, _ = _probed(rows)
    r, salt = rows.column("r")[0].as_py(), rows.column("salt")[0].as_py()
    return _table([(r, 0, salt, len(heads), _pack(key[heads]), _bits(mark))], _PROBES)


def _hits_of_salt(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """A salt's answer, dealt to its chunks."""
    if not rows.num_rows or not answers.num_rows:
        return _table([], _HITS)
    key, source, _, _, _ = _probed(rows)
    hit = _member(key, _union(answers))
    return _answer(rows.column("r")[0].as_py(), rows.column("chunk").to_pylist(), source[hit], key[hit])


def _full_row(r: int, salt: int, chunk: int, h: np.ndarray, g: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> tuple:
    by = np.lexsort((pos, ids))
    places = zlib.compress(np.diff(ids[by], prepend=0).tobytes() + np.diff(pos[by], prepend=0).tobytes(), 1)
    return r, salt, chunk, len(h), h[by].tobytes() + g[by].tobytes(), places


def _first(h: np.ndarray, g: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by hash and place, and the starts of each hash's."""
    order = np.lexsort((pos, ids, g, h))
    h, g = h[order], g[order]
    return order, _groups((h[1:] == h[:-1]) & (g[1:] == g[:-1])) if len(h) else np.zeros(0, int)


def _extend(width: int, n_ranges: int, n_salts: int, bits: int, docs: pa.Table, hits: pa.Table) -> pa.Table:
    rows: list[tuple] = []
    if docs.num_rows and hits.num_rows:
        number = docs.column("chunk")[0].as_py()
        chunk = _Chunk(docs, width, bits)
        at, keys = chunk.blocks()
        hit = np.zeros(len(chunk.words) + 1, np.int64)
        hit[at + 1] = _member(keys, _union(hits))
        hit = np.cumsum(hit)
        at = chunk.windows()
        at = at[hit[at + width - chunk.block] > hit[at]]
        h, g = chunk.full(at)
        doc = chunk.doc_of(at)
        ids, pos = chunk.ids[doc], at - chunk.first[doc]
        order, heads = _first(h, g, ids, pos)
        h, g, ids, pos = (x[order][heads] for x in (h, g, ids, pos))
        r = _ranges(h, 64, n_ranges)
        for i, j in _cuts(r):
            rows.append(_full_row(int(r[i]), number % n_salts, number, h[i:j], g[i:j], ids[i:j], pos[i:j]))
    return _table(rows, _FULL)


def _entries(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """(h, g, ids, pos, sources) of all entries."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    counts = rows.column("n").to_pylist()
    for n, hashes, places in zip(counts, rows.column("hashes").to_pylist(), rows.column("places").to_pylist(), strict=True):
        parts[0].append(np.frombuffer(hashes, np.uint64, n))
        parts[1].append(np.frombuffer(hashes, np.uint64, n, 8 * n))
        place = np.frombuffer(zlib.decompress(places), np.int64).reshape(2, n).cumsum(axis=1)
        parts[2].append(place[0])
        parts[3].append(place[1])
    return *(np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts), np.repeat(np.arange(len(counts)), counts)


def _later_answer(r: int, chunks: list[int], source: np.ndarray, h: np.ndarray, g: np.ndarray) -> pa.Table:
    rows = []
    order = np.lexsort((g, h, source))
    source, h, g = source[order], h[order], g[order]
    for i, j in _cuts(source):  # a chunk names a hash once
        rows.append((r, chunks[int(source[i])], j - i, h[i:j].tobytes() + g[i:j].tobytes()))
    return _table(rows, _LATER)


def _later(rows: pa.Table) -> pa.Table:
    h, g, ids, pos, source = _entries(rows)
    order, heads = _first(h, g, ids, pos)
    h, g, ids, pos, source = (x[order] for x in (h, g, ids, pos, source))
    size = np.diff(heads, append=len(h))
    later = (ids != np.repeat(ids[heads], size)) | (pos != np.repeat(pos[heads], size))
    return _later_answer(rows.column("r")[0].as_py(), rows.column("chunk").to_pylist(), source[later], h[later], g[later])


def _firsts_of_salt(rows: pa.Table) -> pa.Table:
    """The first places of hashes in a salt's chunks, as if it were one chunk."""
    h, g, ids, pos, _ = _entries(rows)
    order, heads = _first(h, g, ids, pos)
    r, salt = rows.column("r")[0].as_py(), rows.column("salt")[0].as_py()
    return _table([_full_row(r, 0, salt, *(x[order][heads] for x in (h, g, ids, pos)))], _FULL)


def _firsts(rows: pa.Table) -> pa.Table:
    """To each salt, the first places of the hashes that it shares with another."""
    h, g, ids, pos, source = _entries(rows)
    order, heads = _first(h, g, ids, pos)
    h, g, source = h[order], g[order], source[order]
    size = np.diff(heads, append=len(h))
    ids, pos = np.repeat(ids[order][heads], size), np.repeat(pos[order][heads], size)
    some = np.flatnonzero(np.repeat(size > 1, size))
    some = some[np.argsort(source[some], kind="stable")]
    salts, r = rows.column("chunk").to_pylist(), rows.column("r")[0].as_py()
    out = []
    for i, j in _cuts(source[some]):
        each = some[i:j]
        out.append(_full_row(r, salts[int(source[each[0]])], 0, h[each], g[each], ids[each], pos[each]))
    return _table(out, _FULL)


def _later_of_salt(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Which entries of a salt's chunks are later than the first place of all, or else of the salt."""
    if not rows.num_rows:
        return _table([], _LATER)
    n = sum(rows.column("n").to_pylist())
    h, g, ids, pos, source = (np.concatenate(x) for x in zip(_entries(rows), _entries(answers), strict=True))
    order, heads = _first(h, g, ids, pos)
    size = np.diff(heads, append=len(h))
    later = np.zeros(len(h), bool)
    later[order] = (ids[order] != np.repeat(ids[order][heads], size)) | (pos[order] != np.repeat(pos[order][heads], size))
    later = np.flatnonzero(later[:n])
    return _later_answer(rows.column("r")[0].as_py(), rows.column("chunk").to_pylist(), source[later], h[later], g[later])


def _merge(width: int, docs: pa.Table, answers: pa.Table) -> pa.Table:
    chunk = _Chunk(docs, width)
    at = chunk.windows()
    gone = np.zeros(len(chunk.words), bool)
    if len(at):
        h, g = chunk.full(at)
        counts, blobs = answers.column("n").to_pylist(), answers.column("hashes").to_pylist()
        of_h, of_g = (np.concatenate([np.frombuffer(b, np.uint64, n, 8 * n * k) for n, b in zip(counts, blobs, strict=True)] or [h[:0]]) for k in (0, 1))
        order = np.lexsort((of_g, of_h))
        later = _find(h, g, of_h[order], of_g[order]) >= 0
        doc = chunk.doc_of(at)
        ids, pos = chunk.ids[doc], at - chunk.first[doc]
        order, heads = _first(h, g, ids, pos)  # repeats inside the chunk
        ids, pos = ids[order], pos[order]
        size = np.diff(heads, append=len(ids))
        later[order] |= (ids != np.repeat(ids[heads], size)) | (pos != np.repeat(pos[heads], size))
        cover = np.zeros(len(gone) + 1, np.int32)
        cover[at[later]] += 1
        np.add.at(cover, at[later] + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
    texts, removed, spans = [], [], []
    for k, text in enumerate(chunk.column.to_pylist()):
        words = text.split()
        drop = gone[chunk.first[k] : chunk.first[k + 1]]
        n = int(drop.sum())
        if n:
            words = [w for w, x in zip(words, drop.tolist(), strict=True) if not x]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], drop.view(np.int8), [0]]))).reshape(-1, 2).tolist() if n else []
        texts.append(b" ".join(words).decode())
        removed.append(n)
        spans.append([{"start": a, "end": b} for a, b in edges])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"doc_id": pa.array([None if i == _NULL_ID else i for i in chunk.ids.tolist()], pa.int64()), "text": pa.array(texts, pa.string()), "n_words": pa.array(np.diff(chunk.first), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, span)})


def _one(f, *args):
    def call(rows: pa.Table) -> pa.Table:
        return f(*args, rows)

    return call


def _two(f, *args):
    def call(docs: pa.Table, answers: pa.Table) -> pa.Table:
        return f(*args, docs, answers)

    return call


def substring_dedup(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES, range_windows: int = RANGE_WINDOWS, salt_chunks: int = SALT_CHUNKS) -> DataFrame:
    """doc_id, text (kept words joined by a space), n_words, n_removed, spans (removed word ranges) of each row."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = 1 + n_bytes // chunk_bytes
    n_ranges = 1 + n_bytes // 5 // range_windows
    n_salts = 1 + n_chunks // salt_chunks
    bits = min(64, _SPARE_BITS + (n_bytes // 5 + 1).bit_length())
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("d"),
        F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(n_chunks)).alias("chunk"),
        F.col("text").cast("string").alias("text"),
    )
    chunks = rows.mapInArrow(_squeeze, "d long, chunk long, z binary, n_bytes long")
    by_chunk = lambda: chunks.groupBy("chunk")
    probes = by_chunk().applyInArrow(_one(_probe, width, n_ranges, n_salts, bits), _PROBES)
    if n_salts == 1:
        hits = probes.groupBy("r").applyInArrow(_hits, _HITS)
    else:
        of_salts = probes.groupBy("r", "salt").applyInArrow(_probed_salt, _PROBES).groupBy("r").applyInArrow(_hits, _HITS).withColumnRenamed("chunk", "salt")
        hits = probes.groupBy("r", "salt").cogroup(of_salts.groupBy("r", "salt")).applyInArrow(_hits_of_salt, _HITS)
    full = by_chunk().cogroup(hits.groupBy("chunk")).applyInArrow(_two(_extend, width, n_ranges, n_salts, bits), _FULL)
    if n_salts == 1:
        later = full.groupBy("r").applyInArrow(_later, _LATER)
    else:
        firsts = full.groupBy("r", "salt").applyInArrow(_firsts_of_salt, _FULL).groupBy("r").applyInArrow(_firsts, _FULL)
        later = full.groupBy("r", "salt").cogroup(firsts.groupBy("r", "salt")).applyInArrow(_later_of_salt, _LATER)
    return by_chunk().cogroup(later.groupBy("chunk")).applyInArrow(_two(_merge, width), RESULT)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
