from datetime import date

from pyspark.sql import functions as F

from worktally.functions import measures, text


def _values(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("x"))).collect()]


def test_whole_number(spark):
    inputs = ["10012", " 10012", "10012\t", " 10012 ", "+10012", "0010012", "10,012", "10012.0", "10012.00", "१००१२", "1.0012e4", None, "", "  ", "TBD", "N/A", "10.5", "-1", "1,0,0"]
    got = _values(spark, text.whole_number, inputs)
    assert [None if g is None else int(g) for g in got] == [10012] * 11 + [None] * 6 + [-1, None]


def test_number_text(spark):
    assert _values(spark, text.number_text, ["20900", "20900.0", "20900.50", "2,09,00", "0.0", "-3", "1e3", "x", None, ""]) == ["20900", "20900", "20900.5", "20900", "0", "-3", "1000", None, None, None]


def test_day(spark):
    same = ["2024-06-04", "04-Jun-2024", "4-jun-2024", "04-06-2024", "04/06/2024", "Jun 4, 2024 12:00:00 AM", "Jun 4, 2024"]
    assert _values(spark, text.day, same) == [date(2024, 6, 4)] * len(same)
    assert _values(spark, text.day, ["31-Feb-2024", "junk", None, "", "04-Foo-2024"]) == [None] * 5


def test_parse_date_takes_five_notations_only(spark):
    same = ["2024-06-04", "04-Jun-2024", "4-Jun-2024", "04-06-2024", "Jun 4, 2024 12:00:00 AM", "Jun 4, 2024", " 2024-6-4 "]
    assert _values(spark, measures.parse_date, same) == [date(2024, 6, 4)] * len(same)
    assert _values(spark, measures.parse_date, ["31-Feb-2024", "04/06/2024", "junk", None]) == [None] * 4


def test_member_name(spark):
    vectors = {
        "Shri Parimal Nathwani (2026-32)": "PARIMAL NATHWANI",
        "Shri. Parimal Nathwani": "SHRI. PARIMAL NATHWANI",
        "Smt. Sunita Singh (2024-30)": "SUNITA SINGH",
        "Smt Sunita Singh": "SUNITA SINGH",
        "Dr Rajesh Kumar": "RAJESH KUMAR",
        "Mrs. Priya Verma": "PRIYA VERMA",
        "Late Ram Nath Kovind": "RAM NATH KOVIND",
        "Name(2024-30)": "NAME",
        "Name (2024-30)  ": "NAME",
        "Parimal\tNathwani": "PARIMAL NATHWANI",
        "  Parimal   Nathwani  ": "PARIMAL NATHWANI",
        "A. Raja": "A. RAJA",
        "   ": "",
        "": "",
    }
    assert _values(spark, measures.member_name, list(vectors)) == list(vectors.values())
    assert _values(spark, measures.member_name, [None]) == [""]


def test_activity_and_amount(spark):
    assert _values(spark, measures.activity_name, ["WS/MP12/2024-2025/77-Road repair", "Road repair", "", None]) == ["Road repair", "Road repair", "", None]
    assert [None if x is None else float(x) for x in _values(spark, measures.parse_amount, ["5", " 5.25 ", "-1", "0", "x", None, "2,000"])] == [5.0, 5.25, None, None, None, None, None]


def test_fiscal_year_and_band(spark):
    days = spark.sql("SELECT date'2024-03-31' a, date'2024-04-01' b")
    assert days.select(measures.fiscal_year(F.col("a")), measures.fiscal_year(F.col("b")), measures.fiscal_label(measures.fiscal_year(F.col("b")))).first()[:] == (2023, 2024, "2024-25")
    marks = [F.lit(float(m)) for m in (10, 20, 30, 40, 50)]
    none = [F.lit(None).cast("double")] * 5
    one = spark.range(1)
    bands = [measures.band(F.lit(v), m) for v, m in ((5.0, marks), (50.0, marks), (51.0, marks), (5.0, none))] + [measures.band(F.lit(None).cast("double"), marks)]
    assert one.select(*[b.alias(str(i)) for i, b in enumerate(bands)]).first()[:] == (10.0, 90.0, 97.5, 97.5, None)


def test_wilson(spark):
    got = spark.range(1).select(measures.wilson_lower(F.lit(5), F.lit(10)), measures.wilson_lower(F.lit(0), F.lit(0)), measures.shrunk(F.lit(100.0), F.lit(5))).first()
    assert round(got[0], 2) == 23.66 and got[1] == 0.0 and got[2] == 75.0
