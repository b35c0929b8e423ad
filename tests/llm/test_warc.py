"""WARC derivatives of awkward pages, held against records made by hand, in columns and in SQL."""

import datetime
import hashlib

import duckdb
import pandas as pd
import pytest

from rainledger.llm import warc

# page, title, language, links, text
CASES = [
    (
        "<html lang='de'><head><title>Caf&eacute; &mdash;\n x</title></head><body><a class=z href='/a?b=1&amp;c'>A</a>"
        "<a href=/plain>B</a><a data-href=\"/no\" HREF = \"/yes\">C</a><p>It&#8217;s &#x2019;t &amp;lt; &lt;3</p>"
        "<p>&bogus; &#0; &#xD800; &#1114112; AT&T &#128512;</p></body></html>",
        "Café — x", "de", ["/a?b=1&c", "/plain", "/yes"], "A B C It’s ’t &lt; <3\n&bogus; &#0; &#xD800; &#1114112; AT&T 😀",
    ),
    ("<HTML LANG=fr><p>a&nbsp;b&#160;c</p>", "", "fr", [], "a b c"),
    ("&", "", "", [], "&"),
    ("", "", "", [], ""),
    (None, "", "", [], ""),
    ("<p>" + "x&amp;" * 100_000 + "</p>", "", "", [], "x&" * 100_000),
]


def block(title, language, links):
    return f"title: {title}\r\nlanguages: {language}\r\ncharset: \r\n" + "".join(f"outlink: {x}\r\n" for x in links)


def test_pages_give_the_expected_blocks(spark):
    rows = [(i, f"http://x/{i}", c[0], "clash") for i, c in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, date string")
    found = {(r["page_id"], r["record_type"]): r["block"] for r in warc.derive_records(pages).collect()}
    for i, (_, title, language, links, text) in enumerate(CASES):
        assert found[i, "conversion"] == text
        assert found[i, "metadata"] == block(title, language, links)


def test_the_sql_gives_the_same_digests():
    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": range(len(CASES)), "url": "u", "html": [c[0] for c in CASES]}))
    found = {(r[0], r[1]): r[7] for r in con.sql(warc.sql()).fetchall()}
    for i, (_, title, language, links, text) in enumerate(CASES):
        assert found[i, "conversion"] == "sha256:" + hashlib.sha256(text.encode()).hexdigest()
        assert found[i, "metadata"] == "sha256:" + hashlib.sha256(block(title, language, links).encode()).hexdigest()


@pytest.mark.parametrize("kind", ["array", "map"])
def test_date_id_and_headers_of_the_response_are_kept(spark, kind):
    utc = datetime.timezone.utc
    given = [("Server", "n\r\nx"), ("Content-Type", "text/html")]
    shape = "array<struct<k:string,v:string>>" if kind == "array" else "map<string,string>"
    rows = [
        (1, "u", "<p>x</p>", datetime.datetime(2024, 2, 3, 4, 5, 6, tzinfo=utc), "<urn:uuid:1>", given if kind == "array" else dict(given)),
        (2, "u", "<p>x</p>", None, None, None),
    ]
    pages = spark.createDataFrame(rows, f"page_id int, url string, html string, at timestamp, rid string, head {shape}")
    found = {(r["page_id"], r["record_type"]): r for r in warc.derive_records(pages, "at", "rid", "head").collect()}
    for record in ("metadata", "conversion"):
        head = found[1, record]["header"].split("\r\n")
        assert {"WARC-Date: 2024-02-03T04:05:06Z", "WARC-Refers-To-Date: 2024-02-03T04:05:06Z", "WARC-Refers-To: <urn:uuid:1>"} <= set(head)
        assert f"WARC-Payload-Digest: {found[1, record]['block_digest']}" in head
        assert f"WARC-Refers-To-Payload-Digest: sha256:{hashlib.sha256(b'<p>x</p>').hexdigest()}" in head
        assert "Date" not in found[2, record]["header"] and found[2, record]["refers_to"].startswith("<urn:uuid:")
    fields = ["source-server: n x", "source-content-type: text/html"]
    kept = found[1, "metadata"]["block"].split("\r\n")[3:5]
    assert kept == (fields if kind == "array" else fields[::-1])
    assert found[2, "metadata"]["block"] == block("", "", [])


def test_repeated_ids_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (1, "u", "b"), (None, None, None)], "page_id long, url string, html string")
    rows = warc.derive_records(pages).collect()
    assert len(rows) == 8 and len({r["record_id"] for r in rows}) == 6
    assert warc.derive_records(pages.limit(0)).count() == 0
