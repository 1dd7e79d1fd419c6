"""Links, manifests, contents and gaps."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ridewell.sources import archive as A


def test_labels_and_names_become_periods(spark):
    rows = [("May 2024",), ("  all  of 2017 ",), ("Data 2024",), ("January 2019 x",), (None,)]
    made = spark.createDataFrame(rows, "s string").select(A.label_period(F.col("s"))).collect()
    assert [r[0] for r in made] == ["2024-05", "2017", None, None, None]
    links = ["https://x/uploads/2026/02/DonneesOuvertes2025_0102.zip", "https://x/Historique-BIXI-2014.ZIP?d=1", "https://x/Historique-BIXI-2014.zip", "https://x/2020.zip", "https://x/DonneesOuvertes2025.csv"]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in links], "s string").select(A.zip_year(F.col("s"))).collect()] == ["2025", None, "2014", None, None]
    names = ["bikeshare-ridership-2014-2015", "Ridership 2020", "ridership readme 2020", "stations 2020", "ridership"]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in names], "s string").select(A.name_span(F.col("s"))).collect()] == ["2014-2015", "2020", None, None, None]


def test_links_of_a_page(spark):
    html = '<p><a class="x" href="https://d/1">May <b>2024</b></a> <a href="https://d/2">Rules &amp; terms</a> <a href="https://d/3">May 2024</a></p>'
    rows = A.anchors(spark.createDataFrame([("van", html)], "system_id string, html string"))
    assert [(r.href, r.label) for r in rows.collect()] == [("https://d/1", "May 2024"), ("https://d/2", "Rules & terms"), ("https://d/3", "May 2024")]
    found, odd = A.by_period(rows.withColumnRenamed("href", "url"), A.label_period(F.col("label")))
    assert [tuple(r) for r in found.collect()] == [("van", "2024-05", "https://d/1")]
    assert sorted((r.period or "", r.url) for r in odd.collect()) == [("", "https://d/2"), ("2024-05", "https://d/3")]
    answer = '{"result":{"resources":[{"name":"Ridership 2020","url":"u"},{"name":null}]}}'
    assert [tuple(r) for r in A.catalog_resources(spark.createDataFrame([(answer,)], "payload string")).collect()] == [("Ridership 2020", "u"), ("", "")]


@pytest.mark.parametrize("accept", [False, True])
def test_merge_keeps_pins(spark, accept):
    old = spark.createDataFrame([("v", "1", "a", "s1", 1, "csv"), ("v", "2", "b", "s2", 2, "csv"), ("v", "3", "c", "s3", 3, "csv")], "system_id string, period string, url string, sha256 string, bytes long, content_format string")
    new = spark.createDataFrame([("v", "1", "a"), ("v", "2", "B"), ("v", "4", "d")], "system_id string, period string, url string")
    made = {r.period: (r.url, r.sha256, r.status) for r in A.merge(old, new, accept).collect()}
    assert made == {"1": ("a", "s1", "unchanged"), "2": ("B", None, "changed") if accept else ("b", "s2", "changed"), "3": ("c", "s3", "not offered"), "4": ("d", None, "new")}


def test_contents_and_inventory(spark):
    zipped = io.BytesIO()
    with zipfile.ZipFile(zipped, "w") as z:
        z.writestr("a.csv", "x")
    contents = [zipped.getvalue(), b"  <!DOCTYPE html><p>", b"a,b\n1,2\n", b"a,b\r1,2", b"\xff\xfe,\n", b"plain"]
    df = spark.createDataFrame([(bytearray(c),) for c in contents], "content binary")
    assert [r[0] for r in df.select(A.content_kind(F.col("content"))).collect()] == ["zip", "html", "csv", "csv", "unknown", "unknown"]
    sha = hashlib.sha256(b"abc").hexdigest()
    listed = spark.createDataFrame([("v", p, s, n) for p, s, n in (("1", sha, 3), ("2", sha, 4), ("3", "0" * 64, 3), ("4", sha, 3), ("5", None, None))], "system_id string, period string, sha256 string, bytes long")
    files = spark.createDataFrame([("v", p, bytearray(b"abc")) for p in "1235"], "system_id string, period string, content binary")
    assert {r.period: r.status for r in A.inventory(listed, files).collect()} == {"1": "ok", "2": "size", "3": "corrupt", "4": "missing", "5": "pending"}
    gaps = A.month_gaps(spark.createDataFrame([("v", p) for p in ("2023-11", "2024-02", "2017")] + [("w", "2020-01")], "system_id string, period string"))
    assert sorted(tuple(r) for r in gaps.collect()) == [("v", "2023-12"), ("v", "2024-01")]


def test_pins():
    assert A.pin({}, "a", 1)[1] == "pinned" and A.pin({"sha256": "a"}, "a", 1)[1] == "verified"
    assert A.pin({"sha256": "a", "volatile": True}, "b", 1)[1] == "moved" and A.pin({"sha256": "a"}, "b", 1, True) == ({"sha256": "b", "bytes": 1}, "repinned")
    with pytest.raises(A.ArchiveRefused):
        A.pin({"sha256": "a"}, "b", 1)


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def packed(spark, **archives):
    rows = [(k, hashlib.sha256(v).hexdigest(), bytearray(v)) for k, v in archives.items()]
    return spark.createDataFrame(rows, "path string, sha256 string, content binary")


def test_archives_unpack_to_members(spark, tmp_path, monkeypatch):
    one = zipped(a__csv=b"1", readme__txt=b"t", inner__zip=zipped(b__csv=b"2", a__csv=b"3"))
    members = A.unpack(packed(spark, one=one))
    assert sorted((r.member, bytes(r.content)) for r in members.collect()) == [("a.csv", b"1"), ("a.csv", b"3"), ("b.csv", b"2")]
    assert [tuple(r) for r in A.clashes(members).collect()] == [("one", "a.csv", 2)]
    with pytest.raises(Exception, match="neither data"):
        A.unpack(packed(spark, x=zipped(a__exe=b"1"))).collect()
    with pytest.raises(A.ArchiveRefused, match="three deep"):
        deep = zipped(a__csv=b"1")
        for _ in range(5):
            deep = zipped(in__zip=deep)
        list(A._pieces("deep", io.BytesIO(deep), 0))
    monkeypatch.setattr(A, "PIECE", 3)
    assert list(A._pieces("p", io.BytesIO(zipped(a__csv=b"12345678", b__csv=b"")), 0)) == [("a.csv", 0, b"123"), ("a.csv", 1, b"456"), ("a.csv", 2, b"78"), ("b.csv", 0, b"")]
    A.save_manifest(tmp_path / "m.json", {"a": 1})
    assert A.load_manifest(tmp_path / "m.json") == {"a": 1} and A.load_manifest(tmp_path / "n.json") == {}


def test_archives_are_unpacked_once_for_each_checksum(spark, tmp_path):
    store, one, two, moved = str(tmp_path / "store"), zipped(a__csv=b"1"), zipped(b__csv=b"2", c__csv=b"3"), zipped(b__csv=b"4")
    told = lambda members: sorted((r.archive, r.member, bytes(r.content)) for r in members.collect())
    members, fresh = A.unpack_into(store, packed(spark, one=one, two=two, again=one))
    assert len(fresh) == 2 and told(members) == [("again", "a.csv", b"1"), ("one", "a.csv", b"1"), ("two", "b.csv", b"2"), ("two", "c.csv", b"3")]
    assert A.unpack_into(store, packed(spark, one=one, two=two))[1] == []
    members, fresh = A.unpack_into(store, packed(spark, one=one, two=moved))
    assert fresh == [hashlib.sha256(moved).hexdigest()] and told(members) == [("one", "a.csv", b"1"), ("two", "b.csv", b"4")]
    wrong = spark.createDataFrame([("bad", "0" * 64, bytearray(one))], "path string, sha256 string, content binary")
    with pytest.raises(Exception, match="not what its checksum says"):
        A.unpack_into(store, wrong)
    assert A.unpack_into(store, packed(spark, one=one))[1] == []


def test_links_however_they_are_written(spark):
    page = """<A HREF='https://d/1' target=_blank>Caf&eacute; <!-- x --> <i>May</i><br>2024</A><a name="x">none</a><a class=y href=https://d/2?a=1&amp;b=2>two</a><a href="https://d/3">open"""
    rows = A.anchors(spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string"))
    assert [tuple(r) for r in rows.collect()] == [(1, "https://d/1", "Café May 2024"), (1, "https://d/2?a=1&b=2", "two"), (1, "https://d/3", "open")]
