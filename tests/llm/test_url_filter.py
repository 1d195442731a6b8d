"""URL filters: the cascade is exact, in both ways of reaching the pages; odd urls."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparge.llm import url_filter as uf


@pytest.mark.parametrize("inline", [uf.INLINE_BYTES, 0])
def test_cascade_is_exact(spark, monkeypatch, inline):
    monkeypatch.setattr(uf, "SHARD_KEYS", 300)
    dice = random.Random(11)
    keys = [f"k{i}" for i in range(2000)]
    listed = set(dice.sample(keys, 500))
    rows = spark.createDataFrame([(k,) for k in keys + keys[:5]] + [(None,)], "url_key string")
    given = spark.createDataFrame([(k,) for k in sorted(listed) + ["elsewhere", "elsewhere"]] + [(None,)], "key string")
    found = uf.mark_listed(rows, "url_key", given, inline).collect()
    assert len(found) == 2006
    assert all(r.listed == (r.url_key in listed) for r in found)


@pytest.mark.parametrize("share", [0, 2000])
def test_all_or_nothing_listed(spark, share):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("url_key"))
    given = rows.limit(share).withColumnRenamed("url_key", "key")
    assert uf.mark_listed(rows, "url_key", given).filter("listed").count() == share


def test_odd_urls(spark):
    urls = {
        1: None, 2: "", 3: "example.org/es/x", 4: "http://Example.ORG/es/x", 5: "http://a.example.org/en/1?x", 6: "http://notexample.org/es/",
        7: "https://www.shop.com/de/1#x", 8: "https://com/fr/", 9: "http://x.com?utm_source=a", 10: "http://É.com/DE/?utm_a", 11: "http://x.net/p?a=1&utm_b=2",
        12: "http://x.net/p", 13: "http://x.net/q#?utm_", 14: "http://h://x/y", 15: "http://\nhost/z", 16: "://", 17: "http://example.org/",
    }
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in urls.items()] + [(3, urls[3], "h", 1)], "page_id long, url string, host string, listed int")
    got = {r.page_id: tuple(r)[1:5] for r in uf.judge(pages, uf.tracked_keys(pages)).collect()}
    assert got[1] == got[2] == got[3] == got[16] == ("", "", None, "allow")
    assert got[4] == ("example.org", "/es/x", "example.org/es/", "block")
    assert got[5] == ("a.example.org", "/en/1", "example.org/en/1", "block")
    assert got[6] == ("notexample.org", "/es/", "org/", "allow")
    assert got[7] == ("www.shop.com", "/de/1", "com/de/", "block") and got[8][2:] == ("com/fr/", "allow")
    assert got[9] == ("x.com", "", None, "block") and got[10] == ("É.com", "/DE/", None, "block")
    assert got[11][3] == got[12][3] == "block" and got[13][3] == "allow"
    assert got[14] == ("h:", "//x/y", None, "allow") and got[15][0] == "\nhost"
    assert got[17][2:] == ("org/", "allow")
    assert uf.judge(pages, uf.tracked_keys(pages)).count() == 18
    empty = pages.limit(0)
    assert uf.judge(empty, uf.tracked_keys(empty)).count() == 0
