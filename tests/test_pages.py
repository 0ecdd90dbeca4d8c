"""Pages by cursor."""

import datetime as dt

from lodestar.operators import picks


def test_pages_by_cursor_cover_every_row_once(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(f"id{i:03d}", (i * 7) % 5 if i % 11 else None, day + dt.timedelta(hours=i % 4) if i % 13 else None) for i in range(120)] + [(None, 3, day)]
    df = spark.createDataFrame(rows, "id string, completeness_score int, created_at timestamp_ntz").checkpoint()
    want = [r.id for r in df.orderBy(*picks.rank_order()).collect()]
    got, end, pages = [], None, 0
    while True:
        page = picks.next_page(df, end, 17)
        rows = [r.id for r in page.collect()]
        if not rows:
            break
        got, end, pages = got + rows, picks.cursor(page), pages + 1
    assert got == want and pages == 8 and picks.cursor(picks.next_page(df, end)) is None


def test_later_pages_push_the_bound_down(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id as string) as id", "cast(id % 90 as int) as completeness_score", "timestamp_ntz'2024-01-01 00:00:00' as created_at")
    df.write.parquet(str(tmp_path / "t"))
    end = {"completeness_score": 5, "created_at": dt.datetime(2024, 1, 1), "id": "1"}
    plan = picks.next_page(spark.read.parquet(str(tmp_path / "t")), end)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(completeness_score,5)" in plan and "TakeOrderedAndProject" in plan
