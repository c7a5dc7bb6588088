import pytest
from pyspark.sql import functions as F

from strataflow.functions import scalars as S


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "want"), [("https://doi.org/10.1/ABC.", "10.1/abc"), ("  ", None), ("doi: 10.2/x. .", "10.2/x"), ("HTTP://DX.DOI.ORG/10.3/Y", "10.3/y"), (None, None), (" 10.4/z ", "10.4/z")])
def test_normalize_doi(spark, given, want):
    assert one(spark, S.normalize_doi(F.col("v")), v=given) == want


@pytest.mark.parametrize(
    ("y", "m", "d", "w", "want"),
    [
        ("2026", "Aug", "14", "", ("2026-08-14", "day", 2026)),
        ("", "", "", "2025 Winter", ("2025", "year", 2025)),
        ("2025", "13", "1", "", ("2025", "year", 2025)),
        ("2025", "2", "32", "", ("2025-02", "month", 2025)),
        ("2025", "2", "31", "", ("2025-02-31", "day", 2025)),
        ("2025", "September", "", "", ("2025-09", "month", 2025)),
        ("x", "1", "1", "", None),
    ],
)
def test_partial_date(spark, y, m, d, w, want):
    got = one(spark, S.partial_date(*map(F.col, "ymdw")), y=y, m=m, d=d, w=w)
    assert (tuple(got) if got else None) == want


def test_publication_date_takes_the_first_date(spark):
    none, some = S.partial_date(F.lit(""), F.lit(""), F.lit("")), S.partial_date(F.lit("2020"), F.lit("1"), F.lit(""))
    assert tuple(one(spark, S.publication_date([none, some]), v="")) == ("2020-01", "month", 2020)
    assert tuple(one(spark, S.publication_date([none]), v="")) == (None, "unknown", None)


def test_small_scalars(spark):
    assert one(spark, S.collapse_space(F.col("v")), v=" a  b\n c ") == "a b c"
    assert one(spark, S.ordered_distinct(F.split("v", ",")), v="b,,a,b,c,a") == ["b", "a", "c"]
    assert one(spark, S.matched([r"\btumou?rs?\b", r"\bx\b", r"\bleuk(?:a|e)mias?\b"], F.col("v")), v="TUMORS and leuKemia") == [r"\btumou?rs?\b", r"\bleuk(?:a|e)mias?\b"]
    assert one(spark, S.all_digits(F.col("v")), v="123\n") is False
    assert one(spark, S.share_of(F.lit(100), 0.07), v="") == 8
    assert one(spark, S.journal_query(F.col("v"), F.lit("2023-01-01"), F.lit("2023-12-31")), v='A "B"') == '"A \\"B\\""[jour] AND ("2023-01-01"[Date - Publication] : "2023-12-31"[Date - Publication])'
    import hashlib

    assert one(spark, S.hash_rank("s", F.col("v")), v="42") == hashlib.sha256(b"s:42").hexdigest()
    assert one(spark, S.batch_id(F.lit("c"), F.lit("v1"), F.split("v", ",")), v="1,2") == hashlib.sha256(b"c\nv1\n1\n2").hexdigest()[:24]
