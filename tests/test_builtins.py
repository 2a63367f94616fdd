"""Plain Spark functions that queries of this schema rely on, pinned to the expected meaning."""

from pyspark.sql import functions as F


def one(spark, *expressions):
    return tuple(spark.range(1).selectExpr(*expressions).first())


def test_text_functions(spark):
    assert one(spark, "chr(10)", "chr(13)", "length('żółw')", "octet_length('żółw')", "lpad('7', 3, '0')",
               "substring('1990/05/09', 1, 4)", "trim('  a ')", "upper('ż')") == (
        "\n", "\r", 4, 7, "007", "1990", "a", "Ż")


def test_numbers(spark):
    assert one(spark, "try_cast('12' AS int)", "try_cast('x' AS int)", "floor(1.9)", "pmod(-3, 7)",
               "cast(-1.9 AS int)") == (12, None, 1, 4, -1)


def test_regular_expressions(spark):
    assert one(spark, "regexp_instr('a1', '[0-9]')", "'10-823' rlike '^[0-9]{2}-[0-9]{3}$'") == (2, True)


def test_times(spark):
    import datetime as dt

    got = one(spark, "extract(second from timestamp'2024-01-01 00:00:43.523')",
              "timestamp'2024-01-02' - timestamp'2024-01-01'", "to_timestamp('1990/05/09', 'yyyy/MM/dd')")
    assert (float(got[0]), got[1], got[2]) == (43.523, dt.timedelta(days=1), dt.datetime(1990, 5, 9))
    assert spark.range(1).select((F.current_timestamp() <= F.current_timestamp()).alias("x")).first().x


def test_decode_matches_null(spark):
    assert one(spark, "decode(CAST(NULL AS int), NULL, 'a', 'b')", "decode(1, NULL, 'a', 'b')") == ("a", "b")


def test_greatest_skips_null(spark):
    assert one(spark, "greatest(1, CAST(NULL AS int))") == (1,)


def test_whole_rows_as_records(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    record = df.select(F.struct("*").alias("r"))
    assert record.select("r.*").schema == df.schema and record.select("r.name").first()[0] == "a"


def test_null_order_is_stated(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "v long")
    assert [r.v for r in df.orderBy(F.col("v").asc_nulls_last()).collect()] == [0, 1, None]


def test_view_over_view(spark):
    from tablespan.sources.tables import named_view

    named_view(spark.range(3), "tablespan_t1", ["a"])
    assert named_view(spark.sql("SELECT a + 1 FROM tablespan_t1"), "tablespan_t2", ["b"]).columns == ["b"]
    assert spark.sql("SELECT sum(b) FROM tablespan_t2").first()[0] == 6


def test_report_lines_as_text(spark, tmp_path):
    from tablespan.sources.tables import write_report

    df = spark.range(2)
    got = write_report(df, F.format_string("%d. wiersz", "id"), str(tmp_path / "r"))
    assert sorted(r.line for r in got.collect()) == ["0. wiersz", "1. wiersz"]
