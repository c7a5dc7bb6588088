import pytest

from strataflow.llm import html_extract

from .conftest import prose

PAGE = "<html><body><div>Site menu line</div><div>{}</div><div>All rights kept</div></body></html>"


@pytest.mark.parametrize("parts", [1, 2, 5, 9])
def test_equal_pages_in_a_row_get_equal_text(spark, parts):
    same, other = PAGE.format(prose(1, 12)), PAGE.format(prose(2, 12))
    rows = [(0, "http://h.example/00", other), *[(i, f"http://h.example/{i:02d}", same) for i in range(1, 24)], (24, "http://h.example/24", PAGE.format(prose(3, 12)))]
    rows += [(100 + i, f"http://i.example/{i}", same) for i in range(3)] + [(200, "http://j.example/0", other)]
    rows += [(300, "http://k.example/0", same), *[(300 + i, f"http://k.example/{i}", other) for i in range(1, 4)], *[(300 + i, f"http://k.example/{i}", same) for i in range(4, 9)]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    key, adaptive = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, parts)
    spark.conf.set(adaptive, "false")
    try:
        got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    finally:
        spark.conf.set(key, 4)
        spark.conf.unset(adaptive)
    assert len(got) == len(rows)
    want = {0: prose(2, 12), 24: prose(3, 12), **dict.fromkeys(range(1, 24), prose(1, 12))}
    want |= {300 + i: prose(2 if 1 <= i < 4 else 1, 12) for i in range(9)}
    assert {i: got[i] for i in want} == want
    assert all("Site menu line" in got[i] for i in (100, 101, 102, 200))  # no other page on the host to tell by
