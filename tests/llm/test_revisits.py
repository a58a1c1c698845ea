import pytest
from pyspark.sql import functions as F

from lexspark.llm.revisits import canonical_url, resolve_revisits

SCHEMA = "record_id long, url string, captured_at long, kind string, headers map<string,string>, digest string, full string"


@pytest.mark.parametrize(
    ("url", "spelling"),
    [
        ("HTTP://WWW.Example.com:80/a/?utm_source=x#top", "example.com/a"),
        ("https://example.com:443", "example.com"),
        ("https://user@example.com/a?b=2&a=1&fbclid=9", "example.com/a?a=1&b=2"),
        ("https://m.example.com/A?refx=1", "m.example.com/A?refx=1"),
        ("no host", None),
        ("", None),
        (None, None),
    ],
)
def test_spellings(spark, url, spelling):
    row = spark.createDataFrame([(url,)], "u string").select(canonical_url(F.col("u")).alias("c")).first()
    assert row["c"] == spelling


def test_each_case(spark):
    url = "http://a.org/x"
    stored = {"etag": '"1"', "content-length": "9", "cache-control": "old", "last-modified": "mon"}
    rows = [
        (1, url, 10, "revisit", {"etag": '"1"'}, None),  # nothing is earlier
        (2, url, 20, "response", stored, "d2"),
        (3, "https://www.a.org/x/#f", 30, "revisit", {"etag": 'W/"1"', "content-length": "0", "cache-control": "new"}, None),
        (4, url, 31, "revisit", {"last-modified": "mon"}, None),
        (5, url, 32, "revisit", {"last-modified": "tue"}, None),
        (6, url, 33, "revisit", None, None),
        (7, url, 40, "response", None, "d7"),
        (8, url, 40, "revisit", {"etag": '"1"'}, None),  # same time, larger id: the response is earlier
        (9, None, 50, "revisit", {"etag": '"1"'}, None),
        (9, None, 50, "revisit", {"etag": '"1"'}, None),
        (10, "http://b.org/", 99, "revisit", {}, None),
    ]
    found = resolve_revisits(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    by_id = {r["record_id"]: r for r in found}
    assert len(found) == 9
    assert {i: r["status"] for i, r in by_id.items()} == {
        1: "no_response", 3: "resolved", 4: "resolved", 5: "mismatch", 6: "unverified", 8: "mismatch", 9: "no_url", 10: "no_response",
    }
    assert by_id[3]["headers"] == {**stored, "etag": 'W/"1"', "cache-control": "new"} and by_id[3]["digest"] == "d2"
    assert by_id[8]["response_id"] == 7 and by_id[8]["headers"] is None


def test_header_names_in_any_case(spark):
    url = "http://a.org/x"
    rows = [
        (1, url, 1, "response", {"ETag": '"1"', "etag": '"2"', "Content-Length": "9"}, "d1", "x"),
        (2, url, 2, "revisit", {"Etag": '"1"', "CONTENT-LENGTH": "0", "X-Cache": "hit"}, None, "x"),
        (3, url, 3, "revisit", {"ETAG": '"2"'}, None, "x"),
    ]
    found = {r["record_id"]: r for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2]["status"] == "resolved" and found[3]["status"] == "mismatch"
    assert found[2]["headers"] == {"etag": '"1"', "content-length": "9", "x-cache": "hit"}


def test_one_url_with_many_captures(spark):
    """The last response before a range of a hot URL lies in another range."""
    rows = spark.range(4000).select(
        F.col("id").alias("record_id"),
        F.when(F.col("id") % 5 == 4, F.concat(F.lit("http://b.org/"), "id")).otherwise("http://a.org/hot").alias("url"),
        F.col("id").alias("captured_at"),
        F.when(F.col("id") % 1000 == 0, "response").otherwise("revisit").alias("kind"),
        F.create_map(F.lit("etag"), F.lit("1")).alias("headers"),
        F.col("id").cast("string").alias("digest"),
    )
    for r in resolve_revisits(rows).collect():
        hot = r["canonical"] == "a.org/hot"
        assert r["response_id"] == (r["record_id"] // 1000 * 1000 if hot else None)


def test_no_records(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
