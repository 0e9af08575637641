"""Decontamination against a plain search of all windows of all documents and items."""

import random

import pytest

from folioforge.llm import decontaminate
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ITEMS = [
    "Alice, said Bob, walked 12 km to the old market and bought 3 kg of apples while Bob ate 12 pears",
    "Sara has 3 dogs. Sara buys 4 cats. Sara sells 2 birds. How many pets does Sara have now?",
    "Tom reads 12 pages daily. Tom writes 5 pages weekly. Tom prints 40 pages monthly. How many pages are there in a year?",
    "What is 12 + 7 * 5?",
    "What is 2024 - 1997?",
    "1 2 3 4 5 6 7 8 9",
]
DOCS = [
    ITEMS[0],
    "x y z. Alice, said Carl, walked 99 miles to the old market and bought 7 kg of apples while Carl ate 99 pears and so on",
    "x y z. Alice, said Carl, walked 99 miles to the old market and bought 7 kg of apples while Dora ate 98 pears and so on",
    ITEMS[1].replace("Sara", "Maria"),
    ITEMS[2].replace("Tom", "Ben"),
    "Question: " + ITEMS[1].replace("Sara", "Maria"),
    "Ann has 3 dogs. Bob buys 4 cats. Cleo sells 2 birds. Which of the towns does Dan like now?",
    "Red\nGreen\nBlue\nWhite\nBlack\nBrown\nGrey",
    "So what is 12 + 7 * 5? Well.",
    "what is 2024 - 1997? * 5? What is 2024 - 1998?",
    "7 8 1 2 3 4 5 6 7 8 9",
    "1 2 3 4 5 6 7 8 8",
    "What is 12 + 7",
    "Élan vital et Ébène noire",
    None,
    "",
]


def search(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(df, bench).collect()
    return {(r.doc_id, r.item_id): (r.windows, r.reparameterised) for r in rows}, rows


def test_crafted_items(spark):
    docs, items = list(enumerate(DOCS)), list(enumerate(ITEMS))
    got, _ = search(spark, docs, items)
    assert got == brute.contaminated(docs, items, decontaminate.UNITS)
    assert {(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 1), (8, 3), (9, 4), (10, 5)} == set(got)
    assert got[2, 0][0] < got[1, 0][0] and not got[0, 0][1] and got[1, 0][1] and got[3, 1][1]


def test_tables_against_plain_search(spark):
    rng = random.Random(3)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = sorted(docs, key=lambda r: len(r[1] or ""))[:120]
    docs += [(1000 + i, docs[i][1] + "\n" + t.replace("1", "7") + " " + docs[i + 1][1]) for i, (_, t) in enumerate(rng.sample(items, min(len(items), 15)))]
    got, _ = search(spark, docs, items)
    assert len(got) >= 10 and got == brute.contaminated(docs, items, decontaminate.UNITS)


def test_words_of_one_polynomial_are_apart(spark):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    item = f"the quick {word} jumps over a lazy hound today"
    other = item.replace(word, word.translate(str.maketrans("ab", "ba")))
    got, _ = search(spark, [(1, item), (2, other)], [(5, item)])
    assert set(got) == {(1, 5)}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + ITEMS[1]
    docs = [(1, ITEMS[1]), (1, ITEMS[1]), (1, "clean"), (None, ITEMS[1]), (3, None), (4, long)]
    items = [(7, ITEMS[1]), (7, ITEMS[1]), (None, ITEMS[0]), (8, None), (9, "")]
    got, rows = search(spark, docs, items)
    assert len(rows) == 3 and set(got) == {(1, 7), (None, 7), (4, 7)}
    df = spark.createDataFrame([(d, t, d, "c") for d, t in docs], "doc_id long, text string, hash long, Text2 string").withColumnRenamed("Text2", "Text")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted((r[0], r[1]) for r in kept.collect()) == [(1, "clean"), (3, None)]
    assert decontaminate.contaminated(df.select("doc_id", "hash").selectExpr("doc_id", "cast(null as string) as text"), bench).count() == 0


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(spark, empty):
    docs = [] if empty == "docs" else [(1, ITEMS[0])]
    items = [] if empty == "items" else [(1, ITEMS[0])]
    assert search(spark, docs, items)[0] == {}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert decontaminate.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string")).count() == len(docs)


def test_text_that_is_not_utf8(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(concat(X'ff20', CAST('the cat sat on a mat and ate 3 fish' AS BINARY), X'20c3') AS STRING) AS text")
    bench = spark.createDataFrame([(1, "the cat sat on a mat and ate 3 fish")], "item_id long, text string")
    assert decontaminate.contaminated(df, bench).count() == 1
