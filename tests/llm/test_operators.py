"""The operators against plain versions, on small tables and on odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import ann, arrays, bpe_fst, decontaminate, language_id, line_dedup, pretoken, quality, simhash, substring_dedup, token_pack, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "x " * 60), (6, "w" * 5000), (7, "a b c d e\n" * 30), (8, "a b c d e\n" * 30)]


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("n_lines", F.lit("clash")).withColumn("score", F.lit("clash"))


def test_substring_dedup(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for sizes in ({}, {"chunk_bytes": 20_000, "range_windows": 2000}, {"chunk_bytes": 20_000, "range_windows": 2000, "salt_chunks": 3}):
        got = {r.doc_id: (r.n_words, r.n_removed, r.h) for r in substring_dedup.substring_dedup(df, **sizes).withColumn("h", F.sha2("text", 256)).collect()}
        assert got == brute.substring_dedup(docs)


def apart(n):
    """Two different words of n letters that agree under any polynomial hash modulo 2**64."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048])
def test_crafted_words_in_windows(spark, n):
    a, b = apart(n)
    words = [f"w{i}" for i in range(19)]
    rows = [(1, " ".join([*words, a])), (2, " ".join([*words, b])), (3, " ".join([*words, a]))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (20, 0), 2: (20, 0), 3: (20, 20)}


def test_window_in_all_chunks(spark):
    hot = " ".join(f"licence{i}" for i in range(25))
    rows = [(i, f"own{i} text{i} " * 30 + hot + f" tail{i}") for i in range(400)]
    rows += [(None, f"null{i} " + hot) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring_dedup.substring_dedup(df, chunk_bytes=1000, range_windows=2000, salt_chunks=8).collect()
    assert len(out) == len(rows)
    assert {r.n_removed for r in out if r.doc_id is None} == {0}  # the same, first place
    assert {r.n_removed for r in out if r.doc_id is not None} == {58 + 25}


def test_simhash(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == brute.simhash(docs)


def test_simhash_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    one, two = "the quick brown fox jumps over the lazy dog " * 3, "an entirely different text about the weather in spring " * 3
    rows = [(1, one), (1, one), (None, two), (None, two), (5, "a third and lonely text of some words"), (6, one), (5, two), (7, "nothing else is like this one here")]
    kept = corpus_pipeline.simhash_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(kept, key=str) == sorted([(1, one), (None, two), (5, rows[4][1]), (7, rows[7][1])], key=str)


def test_odd_rows(spark, odd):
    assert substring_dedup.substring_dedup(odd).count() == len(ODD)
    assert simhash.near_duplicates(odd).count() == len(ODD)
    cut = line_dedup.line_dedup(odd).collect()
    assert len(cut) == len(ODD)
    assert {r.doc_id: r.n_removed for r in cut}[8] == 31  # with the empty line at the end
    assert next(r for r in cut if r.doc_id == 1).text is None
    assert bpe_fst.digest(odd, bpe_fst.rank_file()).count() == len(ODD)
    bench = spark.createDataFrame([(1, None), (2, "w"), (3, "a b c d e a b c d e")], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(odd, bench).collect()} == {7, 8}
    assert decontaminate.drop_contaminated(odd, bench).count() == len(ODD) - 2
    assert toxicity.drop_toxic(odd, toxicity.Model([], [])).columns == odd.columns


@pytest.mark.parametrize("f", [substring_dedup.substring_dedup, simhash.near_duplicates, line_dedup.line_dedup, lambda d: bpe_fst.digest(d, bpe_fst.rank_file())])
def test_empty_table(odd, f):
    assert f(odd.limit(0)).count() == 0


def test_token_files(spark, odd, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    model = Tokenizer.from_str(spec)
    token_pack.write_shards(odd, f"file://{tmp_path}/a", spec, 50257)
    rows = token_pack.read_shards(spark, f"file://{tmp_path}/a").orderBy("start").collect()
    texts = dict(ODD)
    at = 0
    for r in rows:
        assert r.start == at and r.ids == [*model.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        at += len(r.ids)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in ODD), key=lambda d: -1 if d is None else d)
    token_pack.write_shards(odd, f"file://{tmp_path}/c", spec, 50257, shard_ids=5)
    assert len(token_pack.read_shards(spark, f"file://{tmp_path}/c").select("doc_id", "start", "ids").exceptAll(token_pack.read_shards(spark, f"file://{tmp_path}/a")).collect()) == 0
    assert spark.read.parquet(f"file://{tmp_path}/c/manifest").count() > spark.read.parquet(f"file://{tmp_path}/a/manifest").count()
    token_pack.write_shards(odd.limit(0), f"file://{tmp_path}/b", spec, 50257)
    assert token_pack.read_digest(spark, f"file://{tmp_path}/b").count() == 0


def test_ids_that_do_not_fit():
    with pytest.raises(ValueError):
        token_pack.pack(np.array([1, 300], np.uint32), 8)


def test_documents_against_the_libraries(spark, tmp_path):
    """The first 300 documents by length and the longest one, and crafted words, against both libraries."""
    import hashlib

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()), key=lambda r: (len(r[1]), r[0]))
    docs = [*docs[:300], docs[-1], *((10**6 + i, f"x {w} y") for i, w in enumerate((*apart(1024), *apart(2048))))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ranks = bpe_fst.parse_ranks(bpe_fst.rank_file())
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(docs)
    for r in bpe_fst.digest(df, bpe_fst.rank_file()).collect():
        ids = want.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    model = Tokenizer.from_str(spec)
    token_pack.write_shards(df, f"file://{tmp_path}/d", spec, 50257)
    for r in token_pack.read_shards(spark, f"file://{tmp_path}/d").collect():
        assert r.ids == [*model.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]


def test_long_piece_keeps_states_bounded():
    import public_tokenizers
    import tiktoken

    ranks = bpe_fst.parse_ranks(bpe_fst.rank_file())
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    machine = bpe_fst.Transducer(ranks, most_states=300)
    rng = random.Random(4)
    piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    assert machine.encode(piece.encode()) == want.encode_ordinary(piece)
    assert len(machine.content) <= 300 + 256


def test_many_repeated_lines_in_one_document(spark):
    import time

    rows = [(1, "a\nb\nc"), (2, "\n".join(["a", "b", "c"] * 13_334)), (3, "x\na\nb\nc\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    line_dedup.line_dedup(df.limit(1)).collect()
    began = time.time()
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.line_dedup(df).collect()}
    assert got == {1: (0, "a\nb\nc"), 2: (40_002, ""), 3: (3, "x\ny")}
    assert time.time() - began < 10


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17])
def test_packing(bits):
    ids = np.random.default_rng(0).integers(0, 1 << bits, 10_000).astype(np.uint32)
    blob = b"".join(token_pack.shard_bytes(ids, np.arange(2), np.array([0, 5]), bits, block=33 if bits == 13 else 4096))
    shard = token_pack.Shard(pa.BufferReader(blob))
    for a, b in ((0, 10_000), (17, 9000), (5, 5), (4095, 4097)):
        assert (shard.read(a, b) == ids[a:b]).all()


def test_text_that_is_not_utf8(spark):
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61ff2062c3' AS STRING) AS text")
    text = b"a\xff b\xc3".decode("utf-8", "replace")
    good = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for f in (simhash.near_duplicates, substring_dedup.substring_dedup, lambda d: bpe_fst.digest(d, bpe_fst.rank_file())):
        assert f(bad).collect() == f(good).collect()
    assert toxicity.scored(bad, toxicity.Model([], [])).count() == 1


def test_transducer_against_tiktoken():
    import public_tokenizers
    import tiktoken

    raw = bpe_fst.rank_file()
    ranks = bpe_fst.parse_ranks(raw)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = "ab 'stremdvl\n\t 　é中😀.!?12'’  xyzTheing"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    codec = bpe_fst.Codec(ranks)
    codec.transducer.most = 500  # states are made anew again and again
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert list(ids) == want.encode_ordinary(text)
        assert "".join(codec.decode_stream(ids[i : i + 1] for i in range(len(ids)))) == text


def test_utf8_stream():
    data = "aé中😀z".encode() + b"\xff\xc3(\xe4\xb8"
    for n in (1, 2, 3):
        machine = bpe_fst.Utf8Stream()
        out = "".join(machine.feed(data[i : i + n]) for i in range(0, len(data), n)) + machine.finish()
        assert out == data.decode("utf-8", "replace")


def test_piece_cache_overflow():
    cache = pretoken.PieceCache(lambda pieces: [[len(p)] for p in pieces], most=3)
    for texts in (["a bb ccc"], ["dddd ee a"], ["a a a"]):
        for _, _, chars, offs in pretoken.texts_as_chars(texts):
            ids, first = cache(chars, offs)
            assert ids.tolist() == [len(p) + (i > 0) for i, p in enumerate(texts[0].split())] and first.tolist() == [0, 3]


def test_nearest(spark):
    rng = np.random.default_rng(0)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))] + [(300, [0.0] * 16), (350, None), (400, [float("nan")] * 16), (None, [1.0] * 16)]
    rows += [(500 + i, rows[50][1]) for i in range(40)]  # ties with a query
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "id long, v array<double>"), F.col("id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    use = [(i, np.array(v)) for i, v in rows if i is not None and v and np.isfinite(v).all() and any(v)]
    for q, x in use:
        if q % 50 == 0:
            cos = lambda y: round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 12)  # noqa: E731, B023
            want = sorted((-cos(y), i) for i, y in use if i != q)[:5]
            assert got[q] == [i for _, i in want]
    assert set(got) == {q for q, _ in use if q % 50 == 0}


@pytest.mark.parametrize("isotropic", [True, False])
def test_recall_with_many_centroids(spark, monkeypatch, isotropic):
    """20,000 vectors, 256 centroids, blocks of queries: no cell is left out, whatever the vectors look like."""
    monkeypatch.setattr(ann, "QUERY_BYTES", 1 << 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20_000, 32))
    if not isotropic:
        x += 3 * rng.normal(size=(100, 32))[rng.integers(0, 100, len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df, F.col("id") % 50 == 0, 5).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argsort(-(unit[::50] @ unit.T), axis=1)[:, 1:6]
    assert len(got) == near.size
    assert sum((50 * q, int(i)) in got for q, row in enumerate(near) for i in row) >= 0.99 * near.size


def test_bounds_leave_most_vectors_out(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 128))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = np.zeros((1, 128))
    bits, length, own = ann.encode(unit, centre, ann.rotation(128))
    seen = []
    plain = ann.Nearest._exact
    monkeypatch.setattr(ann.Nearest, "_exact", lambda self, row, *rest: seen.append(len(row)) or plain(self, row, *rest))
    near = ann.Nearest(np.arange(-64, 0), rng.normal(size=(64, 128)), centre, 5)
    for i in range(0, 20_000, 5_000):
        part = slice(i, i + 5_000)
        near.add(np.arange(i, i + 5_000), x[part], np.zeros(5_000, int), bits[part], length[part], own[part])
    assert sum(seen) < 0.3 * 64 * 20_000


def test_nearest_edges(spark):
    rows = [(0, [1.0, 0.0], "x"), (0, [0.0, 1.0], "y"), (50, [1.0, 1.0], "z"), (50, [1.0, 1.0], "z"), (3, [1.0, 1.0], None), (2, [1.0, 1.0], "z"), (100, [1.0], "short"), (7, [2.0, 2.0], "w")]
    df = spark.createDataFrame(rows, "id long, v array<float>, score string").withColumn("rank", F.lit("clash"))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in ann.nearest(df, F.col("id") % 50 == 0, 3).collect())
    half = round(0.5**0.5, 6)
    assert got == sorted([(0, i + 1, v, half) for i, v in enumerate((2, 3, 7))] * 2 + [(50, 1, 2, 1.0), (50, 2, 3, 1.0), (50, 3, 7, 1.0)])
    assert ann.nearest(df.limit(0), F.col("id") % 50 == 0, 3).count() == 0


def held(doc_id, n, k):
    return zlib.crc32(str(doc_id).encode()) % n == k


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op7_language_id(spark, sf).collect()
    assert all(r.held_out == held(r.doc_id, 3, 1) for r in rows)
    out = [langs[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert np.mean(out) > 0.95


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.op5_quality(spark, sf).collect()
    out = [labels[r.doc_id] == r.predicted for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(out) > 0.95
    assert quality.Model(quality.terms(pa.array([], pa.string())), []).score(pa.array(["a", None])).tolist() == [0.5, 0.5]


def test_toxicity_learns_and_tolerates_gaps():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice(["ba", "ne", "ti", "or", "al", "su"]) for _ in range(rng.randint(1, 4)))
    clean = [" ".join(word() for _ in range(60)) + "." for _ in range(300)]
    toxic = [c + " " + rng.choice(["zwickelkopf", "gromfutz"]) + " " + word() for c in clean[:150]]
    model = toxicity.Model(toxic + clean[150:], [1] * 150 + [0] * 150)
    score = model.score(["ba ne zwickelkopf ti", "ba z.w.i.c.k.e.l.k.o.p.f", "g r o m f u t z", "ba zwickxelkopf", "ba ne ti or", None, ""])
    assert (score[:4] > 0.3).all() and (score[4:] < 0.3).all()


@pytest.fixture(scope="module")
def toxic_model():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice(["ba", "ne", "ti", "or", "al", "su"]) for _ in range(rng.randint(1, 4)))
    clean = [". ".join(" ".join(word() for _ in range(12)) for _ in range(5)) for _ in range(300)]
    toxic = [c + " " + rng.choice(["zwickelkopf", "gromfutz"]) + " " + word() for c in clean[:150]]
    return toxicity.Model(toxic + clean[150:], [1] * 150 + [0] * 150)


def test_toxicity_of_a_text_is_its_own(toxic_model):
    texts = ["g r o m f u t z", "a nice day", "b a", "i. g", None, "", "z w", "ba ne zwickelkopf ti", "x", "gro mfu tz", "w" * 100 + " gromfutz", "é É gromfutz"] * 3
    alone = [toxic_model.score([t])[0] for t in texts]
    assert toxic_model.score(texts).tolist() == alone
    for order in ([*range(len(texts))][::-1], random.Random(1).sample(range(len(texts)), len(texts))):
        assert toxic_model.score([texts[k] for k in order]).tolist() == [alone[k] for k in order]
    assert alone[0] > 0.9 and alone[1] < 0.3


def test_segments_stay_inside_sentences(toxic_model):
    assert toxic_model.score(["ba grom futz ti"])[0] >= 0.3
    texts = ["Ba grom futz, abc.", "grom. Futz x", "i d i\no t a b c", "k", "l m n o p", "i.d.i.o.t", "w" * 70]
    found = {}
    for i, _, codes, starts, ends, text, _, joined in toxicity.segments_of(texts):
        for a, b, t, pair in zip(starts, ends, text, joined, strict=True):
            found.setdefault(i + int(t), []).append(("".join(chr(96 + c) for c in codes[a:b]), bool(pair)))
    plain = lambda *names: [(n, False) for n in names]
    assert found[0] == plain("ba", "grom", "futz", "abc") + [("bagrom", True), ("gromfutz", True), ("futzabc", True)]
    assert found[1] == plain("grom", "futz", "x") + [("futzx", True)]
    assert found[2] == plain("i", "d", "i", "o", "t", "a", "b", "c", "otabc") and found[3] == plain("k")
    assert found[4] == plain("l", "m", "n", "o", "p", "lmnop") and found[5] == plain("idiot")
    assert found[6] == plain("w" * 32, "w" * 32, "w" * 32, "w" * 22)


def test_toxicity_of_long_words_is_linear(toxic_model):
    import time

    began = time.time()
    toxic_model.score(["ab" * 1_000_000, "a b " * 300_000])
    assert time.time() - began < 10


def test_gapped_kernel_by_its_definition():
    def counts(word):
        w, out = [63, *word, 63], {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    sub = (w[i], w[j], w[k])
                    out[sub] = out.get(sub, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    rng = random.Random(2)
    words = [[rng.randint(1, 5) for _ in range(rng.randint(1, 12))] for _ in range(30)]
    got = toxicity.kernel([bytes(w) for w in words], [bytes(w) for w in words[:7]])
    for a, w in enumerate(words):
        for b, v in enumerate(words[:7]):
            x, y = counts(w), counts(v)
            size = lambda c: sum(n * n for n in c.values()) ** 0.5
            assert abs(got[a, b] - sum(n * y.get(k, 0) for k, n in x.items()) / size(x) / size(y)) < 1e-6


def test_quality_votes_by_their_definition():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "Gamma!", "delta", "x1"]) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    labels = [rng.randint(0, 1) for _ in texts]
    model = quality.Model(quality.terms(pa.array(texts)), labels)
    asked = [*texts[:20], "beta beta", "", None]
    vector = lambda t: model._latent(model._weighted(quality.terms(pa.array([t], pa.string()))))[0].astype(float)
    known = [(vector(t), y) for t, y in zip(texts, labels, strict=True)]
    for t, got in zip(asked, model.score(pa.array(asked)), strict=True):
        if not t:
            assert got == np.float32(np.mean(labels))
            continue
        near = sorted(((float(vector(t) @ v), y) for v, y in known), reverse=True)
        cut = near[quality.NEIGHBOURS - 1][0]
        if near[quality.NEIGHBOURS][0] > cut - 1e-5:  # a tie at the edge
            continue
        votes = [(max(0, c) ** 4, y) for c, y in near[: quality.NEIGHBOURS]]
        assert abs(got - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 1e-4


def test_language_machines_by_their_definition():
    rng = random.Random(6)
    stems = {"en": ["the", "of", "wh"], "de": ["der", "sch", "un"], "fr": ["le", "que", "eau"], "es": ["el", "cion", "ll"], "fi": ["kk", "aa", "yy"]}
    texts, langs = zip(*((" ".join(rng.choice(stems[c]) + rng.choice("aeiou") for _ in range(40)), c) for c in stems for _ in range(25)), strict=True)
    model = language_id.Model(language_id.sparse(list(texts)), list(langs))
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for text in [*texts[::9], "der que el"]:
        x = language_id.vectors([text])[0].astype(float)
        p = {m: sigmoid(3 * (x @ model.table[:, k] + model.bias[k])) for k, m in enumerate(model.machines)}

        def choose(names, p=p):
            def rank(a):
                sure = [p[a, b] if (a, b) in p else 1 - p[b, a] for b in names if b != a]
                return sum(q >= 0.5 if (a, b) in p else q > 0.5 for q, b in zip(sure, [b for b in names if b != a], strict=True)), sum(sure)

            best = max(names, key=rank)
            return best, rank(best)[1] / max(1, len(names) - 1) if len(names) > 1 else 1.0

        family, sure = choose(model.families)
        lang, inside = choose(model.langs[family])
        name, score = model.predict([text])
        assert name == [lang] and abs(score[0] - sure * inside) < 1e-4


@pytest.mark.parametrize("name", ["op1_ann_rotated_codes", "op2_decontaminate", "op5_quality", "op7_language_id", "op8_toxicity"])
def test_queries_on_empty_tables(spark, tmp_path, name):
    from folioforge import llm

    for table in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{table}.parquet")
    assert llm.queries()[name](spark, f"file://{tmp_path}").count() == 0


def test_learned_operators_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, columns with an operator's own names."""
    texts = ["the cat of the house", "der Hund und die Katze", None, "", "w" * 100_000, "the the the", "1 2 3"] * 4
    rows = [(i if i % 9 else None, t, "en" if i % 2 else None, "s", i) for i, t in enumerate(texts)] + [(1, "der Hund", "de", None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("held_out", "score", "predicted", "h", "toxic", "quality", "u", "top", "r"):
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    marks = [(i, i % 2, (i // 2) % 2) for i in range(20)] + [(None, 1, 1), (3, None, None), (3, 1, 1), (99, 0, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash")).write.parquet(f"file://{tmp_path}/labels.parquet")
    for f, column in ((quality.op5_quality, "score"), (toxicity.op8_toxicity, "score"), (language_id.op7_language_id, "score")):
        got = f(spark, f"file://{tmp_path}").collect()
        assert len(got) == len(rows) and all(0 <= r[column] <= 1 for r in got)


def test_windows_stay_inside_documents():
    buf, offs = np.frombuffer(b"a b cd e f", np.uint8), np.array([0, 5, 5, 10])
    starts, ends, first = arrays.words(buf, offs)
    assert [bytes(buf[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert arrays.window_starts(first, 3).tolist() == [0, 3]


def test_toxicity_filter_keeps_rows_and_columns(spark, toxic_model):
    model = toxic_model
    rows = [(1, None, "a", 0.5), (2, "", "b", None), (3, "you gromfutz", "c", 0.1), (4, "ba ne ti", None, 0.2), (4, "ba ne ti", None, 0.2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r["doc_id"] != 3), key=str)
    renamed = docs.withColumnRenamed("lang", "Text")
    assert sorted(r["doc_id"] for r in toxicity.drop_toxic(renamed, model).collect()) == [1, 2, 4, 4]


@pytest.mark.parametrize("pairs", [1, 7, 1 << 14])
def test_reranking_in_slices_gives_equal_rows(monkeypatch, pairs):
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(90, 16)), rng.normal(size=(70, 16))
    centre = np.zeros((1, 16))
    bits, length, own = ann.encode(x / np.linalg.norm(x, axis=1, keepdims=True), centre, ann.rotation(16))
    monkeypatch.setattr(ann, "RERANKED", pairs)
    near = ann.Nearest(np.arange(-70, 0), q, centre, 5)
    for a, b in ((0, 40), (40, 90)):
        near.add(np.arange(a, b), x[a:b], np.zeros(b - a, int), bits[a:b], length[a:b], own[a:b])
    rows = near.rows(0)
    cosine = (q @ x.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1))
    best = np.argsort(-cosine, axis=1)[:, :5]
    hits = sum(c in best[a] for a, c in zip(rows.column("q").to_pylist(), rows.column("c").to_pylist(), strict=True))
    assert rows.num_rows == 350 and hits >= 0.97 * 350
    for a, c, score in zip(*(rows.column(n).to_pylist() for n in ("q", "c", "score")), strict=True):
        assert abs(score - cosine[a, c]) < 1e-12
