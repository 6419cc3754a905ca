import hashlib

from doclake.llm import warc

from llm_helpers import clash

SCHEMA = "page_id long, url string, html string"


def slow(rows):
    out = []
    for page, _, html in rows:
        b = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == b]
        first = max(same, default=None) if len(b) >= 1000 else None
        kind = "response" if first is None or first == page else "revisit"
        out.append((page, len(b), hashlib.sha1(b).hexdigest(), kind, first if kind == "revisit" else None))
    return sorted(out, key=str)


def pages():
    big, other = "é<p>" * 400, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 60
    return [(1, "http://a/x y\r\nz", big), (5, None, big), (3, "http://b", big), (4, "u", "short"), (6, "u", "short"),
            (7, "u", None), (8, "u", ""), (9, "u", other), (10, "u", other), (11, "u", other + "."),
            (12, "u", "x" * 999), (13, "u", "x" * 999), (14, "u", "y" * 1000), (15, "u", "y" * 1000),
            (None, "u", big), (16, "u", "long " * 200000), (16, "u", "long " * 200000), (None, "v", "z" * 2000),
            (None, "v", "z" * 2000)]


def test_round_trip(spark):
    rows = pages()
    got = warc.archived_pages(clash(spark.createDataFrame(rows, SCHEMA).repartition(3), "digest", "payload", "original"))
    got = got.collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == slow(rows)
    assert all(r.intact for r in got)
    assert {r.target_uri for r in got if r.page_id == 1} == {"http://a/x%20y%0D%0Az"}


def test_archive_text_and_references(spark, tmp_path):
    df = spark.createDataFrame(pages()[:3], SCHEMA)
    warc.write_archives(df, str(tmp_path / "w"), date="2020-02-02T00:00:00Z")
    import gzip
    import glob
    heads = [h for f in glob.glob(str(tmp_path / "w" / "part-*")) for h, _ in warc.parse(gzip.open(f).read())]
    by = {h["X-Page"]: h for h in heads}
    assert by["1"]["WARC-Refers-To"] == by["5"]["WARC-Record-ID"] == by["3"]["WARC-Refers-To"]
    assert by["5"]["WARC-Type"] == "response" and "WARC-Refers-To" not in by["5"]
    assert len({h["WARC-Record-ID"] for h in heads}) == 3
    assert {h["WARC-Date"] for h in heads} == {"2020-02-02T00:00:00Z"}


def test_empty(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).collect() == []
