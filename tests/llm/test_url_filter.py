import duckdb
import pytest

from llm import url_filter

URLS = [
    (1, "https://Example.NET/en/page?x=1"), (2, "http://sub.example.net/en/"), (3, "http://example.net/fr/"), (4, "http://anexample.net/en/"),
    (5, "http://a.example.com/de/x"), (6, "http://a.example.com/DE/x"), (7, "http://some.org/fr/1"), (8, "http://some.org/en/1"),
    (9, "http://x.de/porn/1"), (10, "http://x.de/popcorn/pornstar1"), (11, "http://x.de/casino-bonus"), (12, "http://x.de/casino/casino"),
    (13, "http://x.net"), (14, "http://x.net?porn"), (15, None), (16, "no scheme here/porn"), (17, ""), (18, "http://"), (19, "a://b://c/d#e"),
    (20, "http://x.de/" + "a/" * 50_000 + "xxx"), (20, "http://x.de/" + "a/" * 50_000 + "xxx"), (None, "http://x.org/fr/"), (21, "http://X.ORG/fr/?a"),
]


@pytest.fixture(scope="module")
def judged(spark):
    pages = spark.createDataFrame([(i, u, "x", 3) for i, u in URLS], "page_id bigint, url string, host string, verdict int")
    return url_filter.judge(pages).collect()


def test_rules_and_terms(judged):
    got = {r.page_id: (r.host[:20], r.path[:12], r.rule, r.verdict) for r in judged}
    assert got[1] == ("example.net", "/en/page", "example.net/en/", "allow")
    assert got[2][2:] == ("example.net/en/", "allow") and got[3][2:] == ("net/", "block") and got[4][2:] == ("net/", "block")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == (None, "allow")
    assert got[7][2:] == ("org/fr/", "allow") and got[8][2:] == (None, "allow")
    assert got[9][3] == "block" and got[10][3] == "allow"  # only between boundaries
    assert got[11][3] == "block" and got[12][3] == "allow"  # two distinct soft terms, one twice
    assert got[13] == ("x.net", "", None, "allow")  # an empty path does not start with the rule's
    assert got[14][3] == "block" and got[15] == ("", "", None, "allow") and got[16] == ("", "", None, "block") and got[17] == ("", "", None, "allow")
    assert got[18] == ("", "", None, "allow") and got[19][:2] == ("b:", "//c/d") and got[20][3] == "block" and got[21][2] == "org/fr/"
    assert len(judged) == len(URLS)


def test_same_as_sql(spark, judged):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", URLS)
    result = con.execute(url_filter.sql())
    columns = [d[0] for d in result.description]
    assert sorted(result.fetchall(), key=repr) == sorted((tuple(r[c] for c in columns) for r in judged), key=repr)


def test_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
