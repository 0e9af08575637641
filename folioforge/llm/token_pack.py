"""Token-ID output: ids packed in the minimum vocabulary bits, in blocks with an offset each.

A shard file is: 8 bytes of magic; bits an id (u32), ids a block (u32), ids (u64), blocks (u64), documents
(u64); block offsets (u64 each, from the payload's start); document ids (i64), first ids (u64); the payload.
Every block starts at a byte. unpack() reads any range of ids from the blocks that hold it, with numpy.

Texts are encoded by the tokenizers library, each distinct piece of the pre-tokeniser once a worker (the
library's own split is the pattern of pretoken); a text that holds a special token's string goes to the
library whole. An end id closes each document. Shards are ranges of doc_id of SHARD_IDS ids or a document more, so
that a task holds no more than one; each is written once, under a name of its own attempt, and the manifest that Spark commits
names those that count, so a lost executor leaves no half shard behind. The driver holds one manifest row a
shard. Paths are those of pyarrow's file systems; s3a and s3n mean s3.

Edge cases: a null text is empty and gives only the end id. A null doc_id is the smallest one; rows that
repeat a doc_id are separate documents, in the order of their text's hash. Bytes that aren't UTF-8 are read as
U+FFFD. Other columns are not read. An empty table gives no shards. An id that needs more bits than the vocabulary's
is an error.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, pretoken, shared

MAGIC = b"FFPACK01"
BLOCK_IDS = 4096
END_ID = 0
#: Ids after which a shard ends.
SHARD_IDS = 1 << 23
_HEAD = struct.Struct("<8sIIQQQ")
_NULL_ID = -(1 << 63)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in so many bits each, the lowest bit first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.reshape(-1), bitorder="little").tobytes()


def unpack_block(raw: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    out = np.zeros((n, 32), np.uint8)
    out[:, :bits] = each
    return np.packbits(out, axis=1, bitorder="little").view("<u4").reshape(-1)


def shard_bytes(ids: np.ndarray, doc_ids: np.ndarray, firsts: np.ndarray, bits: int, block: int = BLOCK_IDS) -> Iterator[bytes]:
    sizes = [min(block, len(ids) - i) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *((s * bits + 7) // 8 for s in sizes)])[:-1].astype("<u8")
    yield _HEAD.pack(MAGIC, bits, block, len(ids), len(sizes), len(doc_ids))
    yield offsets.tobytes() + doc_ids.astype("<i8").tobytes() + firsts.astype("<u8").tobytes()
    for i in range(0, len(ids), block):
        yield pack(ids[i : i + block], bits)


class Shard:
    """Random access to a shard file."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        magic, self.bits, self.block, self.n_ids, n_blocks, n_docs = _HEAD.unpack(source.read(_HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        self.offsets = np.frombuffer(source.read(8 * n_blocks), "<u8")
        self.doc_ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        self.firsts = np.frombuffer(source.read(8 * n_docs), "<u8").astype(np.int64)
        self.payload = _HEAD.size + 8 * n_blocks + 16 * n_docs

    def read(self, start: int, end: int) -> np.ndarray:
        """ids start to end of the shard, as unsigned 32-bit integers."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (end - 1) // self.block
        last = min(self.block, self.n_ids - b * self.block)
        self.source.seek(self.payload + int(self.offsets[a]))
        raw = self.source.read(int(self.offsets[b] - self.offsets[a]) + (last * self.bits + 7) // 8)
        if self.block * self.bits % 8 == 0:  # whole blocks leave no gap
            ids = unpack_block(raw, self.bits, (b - a) * self.block + last)
        else:
            size = (self.block * self.bits + 7) // 8
            ids = np.concatenate([unpack_block(raw[i * size :], self.bits, self.block if a + i < b else last) for i in range(b - a + 1)])
        return ids[start - a * self.block : end - a * self.block]


_encoders: dict[str, tuple] = {}


def _encoder(spec: str) -> tuple:
    """(tokenizer, special strings, piece cache), made once a worker."""
    key = f"{len(spec)}-{zlib.crc32(spec.encode())}"
    if key not in _encoders:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(spec)

        def encode(pieces: list[str]) -> list[list[int]]:
            return [e.ids for i in range(0, len(pieces), 4096) for e in model.encode_batch_fast(pieces[i : i + 4096], add_special_tokens=False)]

        special = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        _encoders[key] = (model, special, pretoken.PieceCache(encode))
    return _encoders[key]


def encode_texts(spec: str, texts: list[str | None]) -> Iterator[np.ndarray]:
    """The ids of each text, without an end id, as the tokenizers library gives them."""
    model, special, cache = _encoder(spec)
    for i, j, chars, offs in pretoken.texts_as_chars(texts):
        ids, first = cache(chars, offs)
        for k in range(i, j):
            if any(s in (texts[k] or "") for s in special):
                yield np.array(model.encode(texts[k], add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[first[k - i] : first[k - i + 1]]


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    return pafs.FileSystem.from_uri("s3" + colon + rest if scheme in ("s3a", "s3n") else path)


def write_shards(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes docs (doc_id, text) under path, ids below vocabulary; returns the committed manifest, a row a shard."""
    bits = max(1, (vocabulary - 1).bit_length())
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary file: a few MB

    def store_shard(ids: list[np.ndarray], doc_ids: list[int], number: int) -> pa.RecordBatch:
        store, folder = _store(path)
        store.create_dir(f"{folder}/shards", recursive=True)
        name = f"shards/{uuid.uuid4().hex}.pack"
        lens = np.array([len(x) for x in ids])
        with store.open_output_stream(f"{folder}/{name}") as out:
            for part in shard_bytes(np.concatenate(ids), np.array(doc_ids, np.int64), np.cumsum(lens) - lens, bits):
                out.write(part)
        columns = {"name": name, "first_doc": doc_ids[0], "last_doc": doc_ids[-1], "part": TaskContext.get().partitionId(), "number": number, "docs": len(lens), "ids": int(lens.sum())}
        return pa.RecordBatch.from_pydict({k: [v] for k, v in columns.items()})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        doc_ids: list[int] = []
        held = number = 0
        for batch in batches:
            for d, each in zip(batch.column("d").to_pylist(), encode_texts(spec.value, arrays.texts(batch.column("text"))), strict=True):
                ids.append(np.append(each, np.uint32(end_id)))
                doc_ids.append(d)
                held += len(each) + 1
                if held >= shard_ids:
                    yield store_shard(ids, doc_ids, number)
                    ids, doc_ids, held, number = [], [], 0, number + 1
        if ids:
            yield store_shard(ids, doc_ids, number)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("d"), F.col("text").cast("string").alias("text"))
    ordered = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("d", "h").sortWithinPartitions("d", "h").select("d", "text")
    manifest = ordered.mapInArrow(write, "name string, first_doc long, last_doc long, part long, number long, docs long, ids long")
    manifest.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.parquet(f"{path}/manifest")


def _documents(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, starts, ids, n + 1 places in ids) of some documents of the named shards at a time."""
    store, folder = _store(path)
    for batch in batches:
        for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with store.open_input_file(f"{folder}/{name}") as source:
                shard = Shard(source)
                ends = np.append(shard.firsts[1:], shard.n_ids)
                for i in range(0, len(ends), 256):
                    first, last = shard.firsts[i : i + 256], ends[i : i + 256]
                    doc_ids = pa.array([None if d == _NULL_ID else d for d in shard.doc_ids[i : i + 256].tolist()], pa.int64())
                    yield doc_ids, base + first, shard.read(int(first[0]), int(last[-1])), np.append(first, last[-1]) - first[0]


def _read(spark: SparkSession, path: str, pack, schema: str) -> DataFrame:
    shards = spark.read.parquet(f"{path}/manifest").orderBy("first_doc", "last_doc", "part", "number").collect()  # a row a shard
    starts = np.cumsum([0, *(s["ids"] for s in shards)])
    rows = [(s["name"], int(b)) for s, b in zip(shards, starts, strict=False)]
    if not rows:
        return spark.createDataFrame([], schema)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, ids, offs in _documents(path, batches):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start, pa.int64()), *pack(ids, offs)], names)

    return spark.createDataFrame(rows, "name string, base long").repartition(min(len(rows), 10_000)).mapInArrow(run, schema)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), ids of each document, read back from the files."""
    pack = lambda ids, offs: [pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int64()))]
    return _read(spark, path, pack, "doc_id long, start long, ids array<long>")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the files."""

    def pack(ids: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
        crc = [zlib.crc32(np.ascontiguousarray(ids[a:b], "<u4")) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return [pa.array(np.diff(offs), pa.int64()), pa.array(crc, pa.int64())]

    return _read(spark, path, pack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    path = shared.new_path(spark, "token-pack")
    largest = max(Tokenizer.from_str(spec).get_vocab(with_added_tokens=True).values())
    write_shards(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), path, spec, largest + 1)
    return read_digest(spark, path)
