"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

A token sequence is what the merges give for its bytes exactly if every two neighbours are what the merges
give for their concatenation. So each prefix of a piece has one last token: the longest token that ends there
and stands well after the last token of the prefix before it. Whether tokens may still change depends only on
the longest suffix that starts some token, so a transducer state is that suffix (a trie node) with the last
tokens at its positions. States and transitions are made when first met and kept up to a bound; a boundary
before which all open paths agree is final, and the tokens up to it are emitted. The lookahead is bounded by
the longest token.

A piece that is itself a token is emitted as that token at once, as the tiktoken library does. Tokens that
the merges never produce from their own bytes take no part otherwise.

Decoding joins token bytes. Streaming decoding keeps, as its state, the bytes of the character that a chunk
leaves unfinished, found by a table of lead bytes; what is complete goes through Python's UTF-8 codec, with U+FFFD
for what can't be part of a character.

Edge cases: a null or empty text has no ids. Bytes of a text that aren't UTF-8 are read as U+FFFD. Rows that
repeat are independent. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, pretoken, shared


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def merge(ranks: dict[bytes, int], data: bytes) -> list[bytes]:
    """The merges applied one by one, lowest rank first, leftmost on ties: used on two tokens at most."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """encode(piece) gives token ids; step() is the automaton itself."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 1 << 17):
        self.ranks, self.most = ranks, most_states
        self.by_rank = {i: b for b, i in ranks.items()}
        self.token_lens = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.prefixes = {b[:i] for b in ranks for i in range(1, len(b) + 1)}
        self.own: dict[bytes, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: (suffix, last): last[k] is the last token of the prefix that ends at the suffix's place k,
        # and -1 where nothing is before it; all of it belongs to tokens that aren't emitted yet.
        self.states: dict[tuple[bytes, tuple[int, ...]], int] = {}
        self.content: list[tuple[bytes, tuple[int, ...]]] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._state(b"", (-1,))

    def _state(self, open_: bytes, last: tuple[int, ...]) -> int:
        key = (open_, last)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.content)
            self.content.append(key)
        return number

    def _reachable(self, token: bytes) -> bool:
        known = self.own.get(token)
        if known is None:
            known = self.own[token] = len(merge(self.ranks, token)) == 1
        return known

    def _fits(self, a: int, b: int) -> bool:
        """Whether the merges leave the tokens a and b as they are, side by side."""
        if a < 0:
            return True
        known = self.pairs.get((a, b))
        if known is None:
            x, y = self.by_rank[a], self.by_rank[b]
            joined = x + y
            known = not (joined in self.ranks and self._reachable(joined)) and merge(self.ranks, joined) == [x, y]
            if len(self.pairs) >= 2 * self.most:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and the tokens that are now final."""
        move = self.moves.get(state << 8 | byte)
        if move is None:
            move = self.moves[state << 8 | byte] = self._determinise(state, byte)
        return move

    def _determinise(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        open_, last = self.content[state]
        data = open_ + bytes([byte])
        n = len(data)
        for k in range(max(0, n - self.longest), n):  # the longest token first
            token = self.ranks.get(data[k:])
            if token is not None and self._reachable(data[k:]) and self._fits(last[k], token):
                break
        else:
            raise ValueError(f"byte {byte} has no token")
        last = (*last, token)
        # Tokens may still start where the rest is a prefix of a token, or at the end: what lies before the last
        # boundary that the paths back from all these places share is final.
        lens, done = self.token_lens, n
        for k in range(max(0, n - self.longest), n):
            if data[k:] in self.prefixes:
                at = k
                while at != done:
                    if at > done:
                        at -= lens[last[at]]
                    else:
                        done -= lens[last[done]]
                if not done:
                    break
        out, at = [], done
        while at > 0:
            out.append(last[at])
            at -= self.token_lens[last[at]]
        return self._state(data[done:], last[done:]), tuple(out[::-1])

    def finish(self, state: int) -> tuple[int, ...]:
        """The tokens still open at the end of a piece."""
        open_, last = self.content[state]
        out, at = [], len(open_)
        while at > 0:
            out.append(last[at])
            at -= self.token_lens[last[at]]
        return tuple(out[::-1])

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = 0, []
        for at in range(0, len(piece), 256):
            if len(self.content) > self.most or len(self.moves) > 8 * self.most:  # anew, from the state that is held
                held = self.content[state]
                self._reset()
                state = self._state(*held)
            moves = self.moves
            for byte in piece[at : at + 256]:
                state, done = moves.get(state << 8 | byte) or self.step(state, byte)
                if done:
                    out += done
        return [*out, *self.finish(state)]


class Utf8Stream:
    """An incremental UTF-8 state machine: feed() gives the text that is complete, finish() what is left."""

    #: Lead bytes' ranges, continuation bytes that follow, and the range of the first of these.
    LEADS = [(0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)]

    def __init__(self) -> None:
        self.rest = b""

    def _open(self, data: bytes) -> int:
        """Bytes at the end that may be the start of an unfinished character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                for low, high, more, first, last in self.LEADS:
                    if low <= byte <= high:
                        return back if back <= more and (back == 1 or first <= data[1 - back] <= last) else 0
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data) - self._open(data)
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.rest = self.rest.decode("utf-8", "replace"), b""
        return out


class Codec:
    """Whole texts to ids and back; pieces go through the transducer once and are kept up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        self.transducer = Transducer(ranks)
        self.cache = pretoken.PieceCache(lambda pieces: [self.transducer.encode(p.encode()) for p in pieces])
        size = max(ranks.values()) + 1
        tokens = [self.transducer.by_rank.get(i, b"") for i in range(size)]
        self.lens = np.fromiter(map(len, tokens), np.int64, size)
        self.at = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for i, j, chars, offs in pretoken.texts_as_chars(texts):
            ids, first = self.cache(chars, offs)
            for k in range(j - i):
                yield ids[first[k] : first[k + 1]]

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return arrays.ragged(self.flat, self.at[ids], self.lens[ids])

    def decode_stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of ids that come in chunks, each character as soon as it is whole."""
        machine = Utf8Stream()
        for ids in chunks:
            yield machine.feed(self.decode_bytes(ids).tobytes())
        yield machine.finish()


_codecs: dict[str, Codec] = {}


def codec(raw: bytes) -> Codec:
    """The codec of a rank file, made once a worker."""
    key = f"{len(raw)}-{zlib.crc32(raw)}"
    if key not in _codecs:
        _codecs[key] = Codec(parse_ranks(raw))
    return _codecs[key]


#: Rows encoded at once.
ROWS = 512


def _coded(own: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray], list[str]]]:
    """(doc_ids, ids, decoded texts) of a few rows at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            ids = list(own.encode(arrays.texts(part.column("text"))))
            texts = ["".join(own.decode_stream(each[i : i + 65536] for i in range(0, len(each), 65536))) for each in ids]
            yield part.column("doc_id"), ids, texts


def _map(docs: DataFrame, rank_file: bytes, pack, schema: str) -> DataFrame:
    spec = docs.sparkSession.sparkContext.broadcast(rank_file)  # a vocabulary file: about 1 MB
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, texts in _coded(codec(spec.value), batches):
            yield pa.RecordBatch.from_arrays([doc_ids, *pack(ids, texts)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def encode_decode(docs: DataFrame, rank_file: bytes) -> DataFrame:
    """doc_id, ids (array of ints) and the decoded text of each row."""

    def pack(ids: list[np.ndarray], texts: list[str]) -> list[pa.Array]:
        offs = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(ids).astype(np.int32))), pa.array(texts, pa.string())]

    return _map(docs, rank_file, pack, "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, rank_file: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of docs."""

    def pack(ids: list[np.ndarray], texts: list[str]) -> list[pa.Array]:
        shas = [hashlib.sha256(np.ascontiguousarray(x, "<u4")).hexdigest() for x in ids]
        back = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        return [pa.array([len(x) for x in ids], pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]

    return _map(docs, rank_file, pack, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def rank_file() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read()


def op6_bpe_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), rank_file())
