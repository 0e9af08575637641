"""Article files of three sources to text, tables and coordinates."""

import json

from pyspark.sql import functions as F

from folioforge.functions import model
from folioforge.sources import articles

XML = "<article><front><article-title>A study</article-title><kwd>k1</kwd><kwd>k2</kwd><abstract><p>In MNI space.</p></abstract></front><body><p>Body MNI, not Talairach.</p></body></article>"
LISTING = "<set><extracted-table><table-id>T1</table-id><table-label>Table 1</table-label><original-table><table-wrap/></original-table></extracted-table><extracted-table><table-id>q</table-id><table-label>Table 2</table-label><original-table/></extracted-table><extracted-table><table-id>T3</table-id></extracted-table></set>"


def info(i, **more):
    return json.dumps({"table_id": f"T{i}", "table_label": f"Table {i}", "table_caption": f"cap {i}", "table_foot": "", "n_header_rows": 1, "table_data_file": f"table_00{i}.csv"} | more)


PUBGET = {
    "article.xml": XML,
    "tables/tables.xml": LISTING,
    "tables/table_001_info.json": info(1),
    "tables/table_001.csv": "Region,X,Y,Z,k\nLeft,,,,\na,−12,3.5,+4,\"127,927\"\nb,900,1,2,5\nc,1,n/a,2,5\n",
    "tables/table_002_info.json": info(2, n_header_rows=2),
    "tables/table_002.csv": "a,b,c,d\nUnnamed: 0_level_1,p,q,r\nfoo,1,2,3\nbar,4,5,6\nbaz,,,\n",
    "tables/table_003_info.json": info(3),
    "tables/table_003.csv": "x,y,z\n1,2,3\n",
    "tables/table_004_info.json": info(4),
    "tables/table_005_info.json": "{broken",
}


def rows(spark, *items):
    ident = (None, "1", None, None, None)
    return spark.createDataFrame([(slug, source, ident, files) for slug, source, files in items], f"slug string, source string, identifier {model.IDENTIFIER}, files map<string,string>")


def test_pubget(spark):
    got = articles.extract(rows(spark, ("s", "pubget", PUBGET))).first()
    assert got.full_text == "A study\n\nk1; k2\n\nIn MNI space.\n\nBody MNI, not Talairach." and got.has_coordinates and got.identifier.pmid == "1"
    assert [(t.table_id, t.table_number, t.caption, t.space) for t in got.tables] == [("t1", 1, "cap 1", "MNI"), ("t2", 2, "cap 2", "MNI")]
    assert [[(c.x, c.y, c.z, c.space) for c in t.coordinates] for t in got.tables] == [[(-12.0, 3.5, 4.0, "MNI")], [(1.0, 2.0, 3.0, "MNI"), (4.0, 5.0, 6.0, "MNI")]]
    assert got.error_message.startswith("pubget skipped tables: ") and got.error_message.count("|") == 2
    points = articles.explode_points(articles.extract(rows(spark, ("s", "pubget", PUBGET))))
    assert points.count() == 3


def test_failures_are_rows(spark):
    cases = [("a", "pubget", {"tables/tables.xml": LISTING}), ("b", "pubget", {"article.xml": XML}), ("c", "pubget", {"article.xml": XML, "tables/tables.xml": LISTING}), ("d", "elsevier", {"content.pdf": "x"}), ("e", "elsevier", {"content.xml": "<a/>"}), ("f", "ace", {}), ("g", "other", {}), ("h", "elsevier", {"content.xml": "<a/>", "metadata.json": "{}"}), ("i", "elsevier", {"content.xml": "<a", "metadata.json": "{}"}), ("j", "pubget", None)]
    got = {r.slug: r for r in articles.extract(rows(spark, *cases)).collect()}
    assert len(got) == 10 and all(r.error_message and not r.tables and r.has_coordinates is False for r in got.values())
    assert got["c"].full_text and got["h"].error_message == "the article has no tables"


def test_elsevier(spark):
    content = """<d xmlns:ce="http://u/ce"><ce:para>Talairach space</ce:para><ce:table id="tb1"><ce:label>Table 4</ce:label><ce:caption>Peaks</ce:caption><tgroup><thead><row><entry>Region</entry><entry namest="c2" nameend="c4">Coordinates</entry></row><row><entry/><entry>x</entry><entry>y</entry><entry>z</entry></row></thead><tbody><row><entry>L</entry><entry>1</entry><entry>−2</entry><entry>3</entry></row></tbody></tgroup><ce:legend>note</ce:legend></ce:table></d>"""
    got = articles.extract(rows(spark, ("s", "elsevier", {"content.xml": content, "metadata.json": "{}"}))).first()
    t = got.tables[0]
    assert (t.table_id, t.table_number, t.caption, t.footer, t.space) == ("tb1", 4, "Peaks", "note", "TAL")
    assert [(c.x, c.y, c.z) for c in t.coordinates] == [(1.0, -2.0, 3.0)] and got.error_message is None


def test_saved_page(spark):
    page = "<html><script>MNI</script><p>We use Talairach.<table id=q><caption>Table 2 (MNI)</caption><tr><th>n<th>X<th>Y<th>Z<tr><td>a<td>1<td>2<td>3</tr><tr><td>b<td colspan=3>none</table><table><tr><td>only text</td></tr></table></html>"
    got = articles.extract(rows(spark, ("s", "ace", {"1.html": page}))).first()
    assert got.full_text == "We use Talairach." and got.has_coordinates
    assert [(t.table_id, t.table_number, t.space, len(t.coordinates)) for t in got.tables] == [("2", 2, "MNI", 1), ("table-002", None, "TAL", 0)]


def test_audit_and_folders(spark, tmp_path):
    for name, text in PUBGET.items():
        path = tmp_path / "pmcid_7" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    (tmp_path / "pmcid_7" / "odd.txt").write_bytes(b"a\xffb")
    folder = articles.read_folder(spark, f"file://{tmp_path}").first()
    assert folder.files == PUBGET | {"odd.txt": "a�b"} and folder.dir.endswith("pmcid_7")
    got = articles.audit(rows(spark, ("s", "pubget", PUBGET), ("t", "pubget", {"article.xml": "x"}), ("u", "pubget", {"article.xml": "x", "tables/tables.xml": "y"})))
    got = {r.slug: r for r in got.collect()}
    assert got["s"].missing == ["tables/table_004.csv", "Invalid JSON: tables/table_005_info.json"] and not got["s"].success
    assert got["t"].missing == ["tables/tables.xml"] and got["u"].success and got["u"].error_message is None


def test_download_outcomes(spark):
    file = lambda kind: [("p", kind, None, None, None, None)]
    data = [(False, None, None, None, None), (True, False, "gone", None, None), (True, True, None, "boom", None), (True, True, None, None, file("json")), (True, None, None, None, file("xml"))]
    df = spark.createDataFrame(data, f"replied boolean, success boolean, message string, exception string, files array<{model.FILE}>")
    got = df.select(articles.download_outcome(*(F.col(c) for c in df.columns)).alias("o")).select("o.*").collect()
    assert [tuple(r) for r in got] == [(False, "no payload was returned"), (False, "failure: gone"), (False, "exception: boom"), (False, "metadata without a content payload"), (True, None)]


def test_activations(spark):
    df = spark.createDataFrame([("1", "-2.5", "3", "4.1", "12.0"), ("1", "x", "3", "", ""), ("1", "2", "3", "n", None)], "x string, y string, z string, s string, k string")
    got = [r[0] for r in df.select(articles.activation(*(F.col(c) for c in "xyzsk"), F.lit("MNI"))).collect()]
    assert got[1] is None and (got[0].y, got[0].statistic_value, got[0].cluster_size) == (-2.5, 4.1, 12) and got[2].statistic_value is None and got[2].cluster_size is None
