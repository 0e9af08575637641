import random

from pyspark.sql import functions as F

from folioforge.operators import relational as rel
from folioforge.plans import queries, stages
from folioforge.sources import readers, sinks
from folioforge.streaming import incremental

IDS = "pos long, slug string, pmid string, doi string, pmcid string"


def ids(spark, rows):
    return spark.createDataFrame(rows, IDS)


def test_keep_and_upsert(spark):
    df = ids(spark, [(1, "a", "1", None, None), (2, "a", "2", None, None), (3, "b", "3", None, None)])
    assert {r.pos for r in rel.keep_first(df, ["slug"]).collect()} == {1, 3}
    assert {r.pos for r in rel.keep_last(df, ["slug"]).collect()} == {2, 3}
    merged = rel.merge_upsert(df.filter("pos = 3"), df.filter("pos < 3"), ["slug"])
    assert {r.pos for r in merged.collect()} == {2, 3}


def test_lookup_and_cache_split(spark):
    left = ids(spark, [(1, "a", "1", "d1", None), (2, "x", "", "d2", None), (3, "y", None, None, None)])
    right = ids(spark, [(10, "a", None, None, None), (11, "q", None, "d2", None), (12, "r", "1", None, None)]).withColumn("p", F.col("pos"))
    hits, misses = rel.partition_cached(left, right, ["slug", "pmid", "doi", "pmcid"], ["p"])
    assert {(r.pos, r.hit_key, r.hit_p) for r in hits.collect()} == {(1, "slug", 10), (2, "doi", 11)}
    assert [r.pos for r in misses.collect()] == [3]


def test_any_key_fold_ignores_rejected_rows(spark):
    df = ids(spark, [(1, "a", "1", None, None), (2, "b", "1", "d", None), (3, "c", None, "d", None)]).withColumn("g", F.lit(0))
    assert {r.pos for r in rel.any_key_dedup(df, ["slug", "pmid", "doi"], "g").collect()} == {1, 3}


def fold(rows, keys):
    seen, kept = set(), []
    for r in sorted(rows, key=lambda r: r["pos"]):
        mine = {(k, r[k]) for k in keys if r[k]}
        if not mine & seen:
            kept.append(r["pos"])
            seen |= mine
    return kept


def test_any_key_dedup_over_all_rows(spark):
    keys = ["slug", "pmid", "doi", "pmcid"]
    rng = random.Random(2)
    some = lambda n: rng.choice([None, "", *map(str, range(n))])
    rows = [(i, some(400), some(200), some(150), some(300)) for i in range(400)] + [(1000 + i, None, str(1000 + i), str(1001 + i), None) for i in range(4)]
    rows += [(2000 + i, None, "p" + str(i // 2), "d" + str((i + 1) // 2), None) for i in range(7)]  # a chain
    df = ids(spark, rows)
    assert sorted(r.pos for r in rel.any_key_dedup_all(df, keys).collect()) == fold(df.collect(), keys)
    assert rel.any_key_dedup_all(df.limit(0), keys).count() == 0


def test_any_key_query_against_fold(spark):
    sf = "/root/testdata/sf0.01"
    want = fold(queries.ids(spark, sf).collect(), ["slug", "pmid", "doi", "pmcid"])
    assert sorted(r.pos for r in queries.QUERIES["any_key_batch_dedup"](spark, sf).collect()) == want


def test_metadata_fold(spark):
    rows = spark.createDataFrame(
        [("s", 0, "", "J", None, None, ["a"], "xx", ["k1"]), ("s", 1, "T", "K", None, False, ["a", "b"], "yy", ["k2", "k1"])],
        "slug string, p int, title string, journal string, license string, open_access boolean, authors array<string>, abstract string, keywords array<string>",
    )
    r = rel.metadata_fold(rows, "slug", "p").first()
    assert (r.title, r.journal, r.license, r.open_access, r.authors, r.abstract, r.keywords) == ("T", "J", None, False, ["a", "b"], "xx", ["k1", "k2"])


def test_cascade_of_sources(spark):
    df = ids(spark, [(1, "a", "1", None, "PMC1"), (2, "b", "2", None, None), (3, "c", None, None, None)])
    fetch = lambda d: d.withColumn("success", F.col("pos") == 1)
    done, rest = stages.download(df, {s: fetch for s in stages.SOURCES})
    assert {r.pos for r in rest.collect()} == {2, 3}
    assert done[0].count() == 1 and done[1].count() == 1


def test_stage_order_and_settings():
    assert stages.normalize_stages(["Sync", "gather", "sync"]) == ["gather", "sync"]
    assert stages.Settings().merged({"upload_mode": "OVERWRITE"}, {"upload_mode": None}).upload_mode == "OVERWRITE"
    assert stages.run_stages(stages.Settings(dry_run=True), {}).done == stages.STAGES


def test_manifest_round_trip(spark, tmp_path):
    path = f"{tmp_path}/m.jsonl"
    df = spark.createDataFrame([(None, "1", None, None, {"a": "b"})], readers.IDENTIFIER)
    sinks.save_identifiers(df, path)
    assert readers.load_manifest(spark, path).drop("pos").collect() == df.collect()
    assert readers.load_identifiers(spark, f"{tmp_path}/none.jsonl").count() == 0


def test_external_coordinates_replace(spark):
    memory = spark.createDataFrame([("s", "t1", 1.0), ("s", "t2", 2.0)], "slug string, table_id string, x double")
    external = spark.createDataFrame([("s", "t1", "9", "z")], "slug string, table_id string, x string, more string")
    got = {r.table_id: (r.x, r.more, r.region) for r in sinks.coordinates_table(memory.withColumn("x", F.col("x").cast("string")), external).collect()}
    assert got == {"t1": ("9", "z", ""), "t2": ("2.0", "", "")}


def test_incremental(spark, tmp_path):
    source = f"{tmp_path}/in"
    ids(spark, [(1, "", "1", None, None), (2, "", "1", None, None), (3, "", "2", None, None)]).drop("slug").write.json(source)
    got = []
    stream = spark.readStream.schema("pos long, pmid string, doi string, pmcid string").json(source)
    known = spark.createDataFrame([("2",)], "slug string")
    incremental.run(stream, lambda: known, lambda d, n: got.extend(r.pos for r in d.collect()), f"{tmp_path}/ck").awaitTermination()
    assert got == [1]
