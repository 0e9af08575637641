"""SimHash near-dedup: deletion-variant signatures.

A-Z are lower-cased; words are runs of bytes other than ASCII white space; shingles are three words joined by
a space, repeats included (fewer words: the whole sequence). Each shingle's XXH64 (seed 42) votes on the 64
bits of the fingerprint; a bit is set by more than half. Fingerprints link at 2 or fewer differing bits.

Two 32-bit segments: if 2 bits differ at most, one segment differs by at most one bit. Each distinct segment
value is indexed under its 32 one-wildcard variants; a variant holds at most two values, so a partially
aggregated groupBy finds all values one bit apart, without a hot key. Their documents, and those that share a
segment, are joined by equality and verified on the other segment. Where many distinct fingerprints share a
segment value, the other segment is looked up under its one-bit neighbours instead, which costs 33 rows a
fingerprint rather than all pairs of the group; both ways find every link. Exact copies are one fingerprint
from the start. Components come from links between fingerprints, never from pairs of documents.

Edge cases: a null, empty or blank text has fingerprint zero and links like any other. A null doc_id counts
as the smallest id. Rows that repeat a doc_id are separate rows. Bytes that aren't UTF-8 are read as U+FFFD. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import arrays, components, shared

SHINGLE = 3
SEED = 42
_NULL_ID = -(1 << 63)
_ROWS = 1 << 15
#: A segment and its one-bit neighbours.
_BALL = 33


def fingerprint(text: str | None) -> int:
    """The fingerprint, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i:] for i in range(SHINGLE)] if len(words) >= SHINGLE else [[b" ".join(words)]]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*runs, strict=False)), np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _ROWS):
        part = hashes[i : i + _ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in arrays.texts(batch.column("text"))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(prints, pa.int64())], ["d", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(d, fp) of each row: doc_id with null as the smallest long, and the fingerprint's bits as a long."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("d"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, "d long, fp long")


_NEAR = "explode(concat(array(o), transform(sequence(0, 31), i -> o ^ shiftleft(1L, i))))"


def links(classes: DataFrame) -> DataFrame:
    """(a, b): representatives of distinct fingerprints (rep, fp) linked so that components are those of all links."""
    high, low = F.expr("shiftrightunsigned(fp, 32)"), F.expr("fp & 4294967295L")
    members = classes.select("rep", F.explode(F.array(F.struct(F.lit(0).alias("seg"), high.alias("s"), low.alias("o")), F.struct(F.lit(1).alias("seg"), low.alias("s"), high.alias("o")))).alias("m"))
    members = shared.materialize(members.select("rep", "m.seg", "m.s", "m.o"), "segments")
    values = shared.materialize(members.groupBy("seg", "s").agg(F.count("*").alias("n")), "segment-values")

    # Values one bit apart: each wildcard variant holds one or two of them.
    spread = values.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # each row becomes 32
    variants = spread.select("seg", "s", "n", F.expr("explode(transform(sequence(0, 31), j -> struct(j AS j, s & ~shiftleft(1L, j) AS v)))").alias("k"))
    apart = (
        variants.groupBy("seg", "k.j", "k.v")
        .agg(F.count("*").alias("c"), F.min("s").alias("s1"), F.max("s").alias("s2"), F.min_by("n", "s").alias("n1"), F.max_by("n", "s").alias("n2"))
        .filter("c = 2")
        .select("seg", F.expr("if(n1 < n2, s2, s1)").alias("s1"), F.expr("if(n1 < n2, s1, s2)").alias("s2"), F.expr("greatest(n1, n2)").alias("n1"), F.expr("least(n1, n2)").alias("n2"))
    )
    apart = shared.materialize(apart, "segment-pairs")
    left = members.select("seg", F.col("s").alias("s1"), F.col("o").alias("o1"), F.col("rep").alias("a"))
    right = members.select("seg", F.col("s").alias("s2"), F.col("o").alias("o"), F.col("rep").alias("b"))
    few = f"n1 * n2 <= n1 + {_BALL} * n2"
    one_each = apart.filter(few).join(left, ["seg", "s1"]).join(right, ["seg", "s2"]).filter("bit_count(o1 ^ o) <= 1").select("a", "b")
    crowd = apart.filter(f"NOT ({few})")
    probes = crowd.join(right, ["seg", "s2"]).select("seg", "s1", "s2", "b", F.expr(_NEAR).alias("o1"))
    looked_up = probes.join(crowd.join(left, ["seg", "s1"]).select("seg", "s1", "s2", "o1", "a"), ["seg", "s1", "s2", "o1"]).select("a", "b")

    # Equal values: the other segments differ by one or two bits.
    shared_value = values.filter("n > 1")
    same = members.join(shared_value.filter(f"n <= {2 * _BALL}"), ["seg", "s"]).select("seg", "s", "o", "rep")
    pairs = same.select("seg", "s", F.col("o").alias("o1"), F.col("rep").alias("a")).join(same.withColumnRenamed("rep", "b"), ["seg", "s"])
    pairs = pairs.filter("a < b AND bit_count(o1 ^ o) <= 2").select("a", "b")
    # All fingerprints within one bit of the same value are within two of each other: a star links them.
    balls = members.join(shared_value.filter(f"n > {2 * _BALL}"), ["seg", "s"]).select("seg", "s", "rep", F.expr(_NEAR).alias("v"))
    stars = balls.groupBy("seg", "s", "v").agg(F.min("rep").alias("a"), F.collect_list("rep").alias("all")).filter("size(all) > 1").select("a", F.explode("all").alias("b"))
    return one_each.union(looked_up).union(pairs).union(stars.filter("a <> b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of each row: fingerprint bits as a long, smallest doc_id reachable by links."""
    prints = shared.materialize(fingerprints(docs), "fingerprints")
    classes = shared.materialize(prints.groupBy("fp").agg(F.min("d").alias("rep")), "fingerprint-classes")
    roots = components.connected_components(links(classes))
    of = classes.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component"))
    real = lambda c: F.nullif(F.col(c), F.lit(_NULL_ID))
    return prints.join(of, "fp").select(real("d").alias("doc_id"), "fp", real("component").alias("component_id"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
