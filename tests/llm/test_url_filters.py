import random

import duckdb
import pyarrow as pa

from foliorank.llm import url_filters

SCHEMA = "page_id long, url string, html string"


def verdicts(spark, rows):
    found = url_filters.judge_urls(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", host string"))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def by_sql(rows):
    with duckdb.connect() as connection:
        table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(("page_id", "url", "html"))},
                         schema=pa.schema({"page_id": pa.int64(), "url": pa.string(), "html": pa.string()}))
        connection.register("pages", table)
        return sorted(connection.sql(url_filters.URL_SQL).fetchall(), key=str)


def canonical(link):
    return f'<html><head><LINK rel="canonical" href="{link}"></head>'


def test_forms_of_links(spark):
    blocked = "http://a.org/moved.html"
    rows = [
        (1, blocked, canonical("http://x.net/es/1")),
        (2, "http://a.org/d/page", canonical("../moved.html")),
        (3, "https://a.org/d/e/", '<meta http-equiv="refresh" content="0; url=/./d/../moved.html">'),
        (4, "http://a.org:80/moved.html?q=1", canonical("//A.ORG/moved.html#top")),
        (5, "http://b.org", canonical("http://x.net/fr/2")),
        (6, "http://b.org/", ""),
        (7, "http://c.org/q?a=1&b=2", ""),
        (8, "http://c.org/", canonical("/q?a=1&amp;b=2")),
        (9, "http://x.net/es/9", canonical("http://c.org/q?a=1&b=2")),
        (10, "http://clean.org/", "<!-- " + canonical("http://x.net/es/1") + " -->"),
        (11, "http://www.example.com/en/", canonical("http://x.net/es/1")),
        (12, "http://d.org/go", canonical("/go?u=https://x.net/es/1")),
        (13, "http://e.org/", canonical("mailto:a@x.net") + canonical("") + canonical("?id=2")),
        (14, "nothing", canonical("http://x.net/es/1")),
        (15, None, None),
        (None, "http://e.org/", None),
        (16, "http://f.org/", "x" * 300_000 + canonical("moved") + canonical("http://x.net/fr/z")),
    ]
    found = verdicts(spark, rows)
    assert {r[0] for r in found if r[4] == "block"} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 16}
    assert found == by_sql(rows)


def test_equals_sql_on_generated_pages(spark):
    rng = random.Random(4)
    hosts = ["a.org", "b.org", "x.net", "example.com", "www.example.com", "c.com", "A.org:80", "b.org:8080"]
    paths = ["", "/", "/en/1", "/es/1", "/fr/", "/d/e", "/d/./f", "/q?x=1", "/d/../en/2", "#f"]
    links = ["../x", "./", "", "y/z", "?k=v", "#top", "//b.org/d/e", "mailto:q", *(f"http://{h}{p}" for h in hosts for p in paths)]
    rows = []
    for i in range(150):
        tags = "".join(canonical(rng.choice(links)) for _ in range(rng.choice([0, 0, 1, 2])))
        if rng.random() < 0.2:
            tags += f"<META HTTP-EQUIV=refresh content='1;URL={rng.choice(links)}'>"
        if rng.random() < 0.1:
            tags = f"<!--{tags}-->"
        rows.append((i, rng.choice(["http", "https", "HTTP"]) + "://" + rng.choice(hosts) + rng.choice(paths), tags))
    rows += [rows[3], (None, rows[5][1], rows[5][2])]
    found = verdicts(spark, rows)
    assert found == by_sql(rows)
    assert {r[4] for r in found} == {"allow", "block"} and sum(r[3] is None and r[4] == "block" for r in found) > 5


def test_nothing(spark):
    assert url_filters.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
