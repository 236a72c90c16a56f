import json
import os


from trendlake.operators.curate import REFERENCE_KEYS, curate_comments, curate_trending, dedup
from trendlake.sources.landing import read_comment_records, read_trending_docs
from tests.test_flatten import _item


def _land(root, kind, region, date, name, payload):
    d = os.path.join(root, kind, f"region={region}", f"date={date}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(json.dumps(payload))


def test_dedup_keeps_max_views_with_deterministic_ties(spark):
    df = spark.createDataFrame(
        [("US", "v", 5, "b"), ("US", "v", 9, "a"), ("US", "v", 9, "c"), ("CA", "v", None, "z"), ("CA", "v", 1, "y")],
        "region string, video_id string, view_count int, tag string",
    )
    by_snapshot = {r.region: r for r in dedup(df, ("region", "video_id")).collect()}
    assert by_snapshot["US"].view_count == 9 and by_snapshot["US"].tag == "a"  # tie -> smallest tag
    assert by_snapshot["CA"].view_count == 1  # nulls last
    only = dedup(df, REFERENCE_KEYS).collect()
    assert len(only) == 1 and only[0].view_count == 9


def test_curate_trending_from_landing(spark, tmp_dir):
    _land(tmp_dir, "trending", "US", "2024-01-02", "a.json",
          {"items": [_item("v1", title="Hello  http://x.y/z   WORLD"), _item("v1", views="20"),
                     _item(None), _item("v2", title=None), _item("v3", published=None)]})
    _land(tmp_dir, "trending", "MIDDLE EAST", "2024-01-02", "b.json", {"items": [_item("v1")]})
    _land(tmp_dir, "trending", "US", "2024-01-03", "c.json", {"items": []})
    cur = curate_trending(read_trending_docs(spark, os.path.join(tmp_dir, "trending")))
    rows = sorted(cur.collect(), key=lambda r: r.region)
    assert [(r.region, r.video_id, r.view_count) for r in rows] == [("MIDDLE EAST", "v1", 10), ("US", "v1", 20)]
    r = rows[1]
    assert str(r.trending_date) == "2024-01-02" and r.trending_date_raw == "2024-01-02"
    assert (r.published_hour, r.published_year, r.published_week) == (10, 2024, 1)
    assert r.source_file.endswith("a.json")
    assert r.title_clean == "t"  # the v1 row with 20 views has title "t"


def test_title_clean_keeps_edges(spark):
    from trendlake.functions.text import clean_title

    df = spark.createDataFrame([(" A  https://x.io/q?a=1 B ",)], "t string")
    assert df.select(clean_title("t").alias("c")).first().c == " a b "


def test_curate_comments_from_landing(spark, tmp_dir):
    _land(tmp_dir, "comments", "US", "2024-01-02", "a.json", [
        {"videoId": "v1", "comments": [{"videoId": None, "authorDisplayName": "x", "textDisplay": "hi",
                                        "publishedAt": "p", "likeCount": 1}]},
        {"videoId": "v2", "comments": []},
        {"videoId": None, "comments": []},
    ])
    out = curate_comments(read_comment_records(spark, os.path.join(tmp_dir, "comments")))
    rows = sorted(out.collect(), key=lambda r: r.video_id)
    assert [r.video_id for r in rows] == ["v1", "v2"]
    assert str(rows[0].ingest_date) == "2024-01-02" and rows[0].region == "US"
    assert out.schema["ingest_date"].dataType.typeName() == "date"
    assert rows[0].comment_text == "hi" and rows[1].comment_text is None
