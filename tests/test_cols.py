import pytest
from pyspark.sql import functions as F

from folioforge.functions import cols


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (cols.normalize_pmid, " 12345 ", "12345"),
        (cols.normalize_pmid, "https://pubmed.ncbi.nlm.nih.gov/77/", "77"),
        (cols.normalize_pmid, "  ", None),
        (cols.normalize_doi, "https://doi.org/10.1234/example ", "10.1234/example"),
        (cols.normalize_doi, "DOI:10.1/X", "10.1/X"),
        (cols.normalize_pmcid, " 654321 ", "PMC654321"),
        (cols.normalize_pmcid, "pmc1", "pmc1"),
        (cols.slugify, "A b--C!", "a-b-c"),
        (cols.coordinate_space, "talairach", "TAL"),
        (cols.statistic_kind, "beta", "T"),
        (cols.statistic_kind, "b", "B"),
        (cols.statistic_kind, None, None),
        (cols.table_number, "Table 12b", 12),
        (cols.cluster_size, "-7", 7),
        (cols.year_of, "Winter 2003", 2003),
        (cols.pmcid_from_path, "/a/pmcid_12/pmc34/t.xml", "PMC34"),
        (cols.pmcid_digits, "PMC007", "7"),
        (cols.number, "1_0", None),
        (cols.number, " 1.5 ", 1.5),
        (cols.html_verdict, None, "empty"),
        (cols.html_verdict, "<html>captcha", "blocked"),
        (cols.strip_nul, "a\x00b", "ab"),
        (cols.manifest_filename, "a::b", "a-b"),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, f, value) == want


def test_map_and_lists(spark):
    assert one(spark, cols.normalize_other_ids, {"a": " ", "b": " x "}, "map<string,string>") == {"b": "x"}
    got = one(spark, cols.abstract_text, [("Aim", "a"), (None, "b"), (None, "")], "array<struct<label:string,text:string>>")
    assert got == "Aim: a\n\nb"
    names = one(spark, cols.author_names, [(None, "Ann", "A", "Lee"), ("Group", None, None, None), (None, None, None, "")], "array<struct<collective:string,fore:string,initials:string,last:string>>")
    assert names == ["Ann Lee", "Group"]
