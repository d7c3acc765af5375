import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from natspark.llm import lines


def pages_of(spark, rows):
    full = [(*r, "h", 1, "k") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, host string, drop int, kept_lines string").repartition(3)


def page(k, *parts):
    return "<html><head><title>T%d</title><style>p{}</style><script>var x='</p>Unseen';</script></head><body>%s</body></html>" % (k, "".join(f"<p>{p}</p>" for p in parts))


def site(spark=None):
    rows = [(k, f"https://User@Big.example.org:80/{k}", page(k, "Menu <b>bar</b>", f"own {k}", "often" if k % 3 else f"rare {k}")) for k in range(60)]
    rows += [(100 + k, f"http://small.example.org/{k}", page(k, "Menu bar", "own")) for k in range(3)]
    rows += [(200, None, page(1, "Menu bar")), (201, "not a url", "plain\n\n  text \r\n plain<br/>x"), (202, "http://small.example.org", None), (203, "http://e.org/", "")]
    rows += [(204, "http://big.example.org/long", page(2, *[f"line {j}" for j in range(5000)], "Menu bar")), (5, "http://big.example.org/again", page(5, "Menu bar", "Menu bar"))]
    return [*rows, (None, "http://big.example.org/none", page(7, "Menu bar", "last"))]


def test_lines_of_a_page(spark):
    cases = [(page(1, "a  <i>b</i>", " ", "c&amp;d"), ["T1", "a b", "c&amp;d"]), ("<!-- <p>no</p> -->yes<BR>no<pre\nx=1>z", ["yes", "no", "z"]), ("<prefix>a</prefix>b", ["ab"]), (None, [])]
    for html, want in cases:
        assert spark.createDataFrame([(html,)], "h string").select(lines.page_lines(F.col("h"))).first()[0] == want


@pytest.mark.parametrize("url, want", [("HTTP://u:p@A.b:8/x", "a.b"), ("https://a.b?x", "a.b"), ("//a.b", ""), ("", ""), (None, "")])
def test_hosts(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(lines.host(F.col("u"))).first()[0] == want


def test_boilerplate_is_dropped(spark):
    got = {r.page_id: r for r in lines.deduped(pages_of(spark, site())).select("page_id", "lines", "_kept_lines").collect()}
    kept = {k: r["_kept_lines"] for k, r in got.items()}
    assert kept[0] == ["T0", "own 0", "rare 0"] and kept[1] == ["T1", "own 1"]  # "often" is on two thirds of the pages
    assert kept[100] == ["T0"] and kept[102] == ["T2"]  # a host of four pages: on three of them, and on one
    assert kept[200] == ["T1", "Menu bar"]
    assert len(kept[204]) == 5001 and kept[5] == ["T5"] and kept[None] == ["T7", "last"] and kept[202] == [] and kept[203] == []


def test_equal_to_sql(spark):
    docs = pages_of(spark, site()).where("page_id is not null")
    con = duckdb.connect()
    con.register("pages", docs.toPandas())
    assert sorted(map(str, map(tuple, lines.digests(docs).collect()))) == sorted(map(str, con.execute(lines.ORACLE).fetchall()))


def test_other_columns_and_empty_tables(spark):
    docs = pages_of(spark, site())
    got = lines.deduped(docs)
    assert got.columns[: len(docs.columns)] == docs.columns and got.count() == len(site())
    assert lines.digests(pages_of(spark, [])).count() == 0
    assert lines.digests(pages_of(spark, [(1, None, None)])).first().kept_sha256 == hashlib.sha256(b"").hexdigest()
