"""Contract queries against their DuckDB equivalents, on the smallest tables and on a web with links."""

import math
import os

import duckdb
import pytest

from cartospark.llm import queries, url_trust
from cartospark.llm.oracles import ORACLES

DATA = "/root/testdata/sf0.001"


def plain(rows, order):
    cell = lambda x: round(x, 9) if isinstance(x, float) and math.isfinite(x) else x
    return sorted(repr(tuple(cell(r[k]) for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    mine, theirs = queries.QUERIES[name](spark, DATA), con.sql(ORACLES[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine.collect(), range(len(mine.columns))) == plain(theirs.fetchall(), [theirs.columns.index(c) for c in mine.columns])


def test_verdicts_by_links_equal_the_oracle(spark):
    """Hosts that only links lead to: towards blocked ones, away from trusted ones, and in a ring."""
    to = lambda *hosts: "".join(f'<a HREF = "https://{h}/x">x</a><img src="//zz/">' for h in hosts)
    pages = [
        (1, "http://good.net/de/1", to("a.ee", "b.ee")), (2, "http://good.net/fr/1", to("A.EE")), (3, "http://bad.com/en/1", to("c.ee")), (4, "http://a.ee/", to("d.ee", "bad.com")),
        (5, "http://b.ee/", to("d.ee", "e.ee", "e.ee")), (6, "http://c.ee/?q", to("bad.com")), (7, "http://d.ee/p", to("b.ee")), (8, "http://e.ee#f", to("f.ee", "c.ee")),
        (9, "http://f.ee/", to("c.ee", "g.ee")), (10, "http://g.ee/", to("f.ee")), (11, None, to("bad.com")), (12, "no host", None), (13, "http://bad.com/en/1", ""),
        (14, "http://worse.ee/", to("bad.com")),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    theirs = con.sql(ORACLES["op2_url_filters"])
    mine = url_trust.judged(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.URL_RULES).select(*theirs.columns).collect()
    assert plain(mine, range(5)) == plain(theirs.fetchall(), range(5))
    verdict = {r["page_id"]: r["verdict"] for r in mine}
    assert verdict[14] == "block" and verdict[2] == verdict[7] == "allow" and len(verdict) == len(pages)
