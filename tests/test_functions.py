import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablespan.functions import arrays, checks, draws, text
from tablespan.operators import quality, synth

# fixed values: numbers known to be valid
VALID_NIPS = ["8506725473", "4131146574", "4761074505", "6460655734", "8114684466", "4443708562", "2751673516",
              "6235706042", "6605385789", "8582028206", "4743540084", "6355202255", "5715681212", "7888650117"]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_proper_case(spark):
    assert one(spark, text.proper_case(F.lit("jean-paul o'neil ŻÓŁW2b")))[0] == "Jean-Paul O'Neil Żółw2b"


def test_positions_and_tokens(spark):
    s = F.lit("a b  c d")
    assert one(spark, text.nth_position(s, " ", 1), text.nth_position(s, " ", 3), text.nth_position(s, " ", 9),
               text.last_token(s), text.last_token(F.lit("abc"))) == (2, 5, 0, "d", "abc")


def test_null_counts_as_empty_text(spark):
    assert one(spark, text.joined("a", F.lit(None).cast("string"), F.lit(7)))[0] == "a7"


def test_percent_text(spark):
    assert one(spark, text.percent_text(F.lit(1 / 594)), text.percent_text(F.lit(1 / 1943))) == ("000.168350", "000.051467")


def test_nip(spark):
    df = spark.createDataFrame([(n,) for n in VALID_NIPS + ["1234567890", "12345", "123456789x", None]], "n string")
    got = {r.n: r.ok for r in df.select("n", checks.nip_ok(F.col("n")).alias("ok")).collect()}
    assert all(got[n] for n in VALID_NIPS)
    assert got["1234567890"] is False and got["12345"] is False and got["123456789x"] is False and got[None] is None


@pytest.mark.parametrize("value, ok", [
    ("1990/05/09", True), ("2000/02/29", True), ("1999/02/29", False), ("1990/13/01", False), ("1990-05-09", False),
    ("2020/01/01", False), ("2019/12/31", True), ("1990/5/9", False), (None, False)])
def test_birth_date(spark, value, ok):
    today = F.lit(dt.date(2020, 1, 1))
    assert one(spark, checks.birth_date_ok(F.lit(value).cast("string"), today))[0] is ok


def test_email_and_null(spark):
    got = one(spark, *[checks.email_ok(F.lit(v).cast("string")) for v in
                       ("a@b.pl", "aATb.pl", "a@b.museum", "@b.pl", None)])
    assert got == (True, False, False, False, None)


def test_collections(spark):
    a = F.array(F.lit("x"), F.lit("y"))
    empty = F.array().cast("array<string>")
    assert one(spark, arrays.has_element(a, "x"), arrays.has_element(empty, "x"),
               arrays.append_missing(a, F.array(F.lit("y"), F.lit("z"), F.lit("z"))),
               arrays.same_elements(a, F.array(F.lit("y"), F.lit("x"), F.lit("x"))),
               arrays.updated(a, empty, F.lit(None).cast("string"))) == (
        True, False, ["x", "y", "z", "z"], False, ["x", "y"])
    assert one(spark, F.size(arrays.bounded(F.sequence(F.lit(1), F.lit(50)), 50))) == (50,)
    with pytest.raises(Exception, match="more than 50"):
        one(spark, F.size(arrays.bounded(F.sequence(F.lit(1), F.lit(53)), 50)))


def test_first_failed_rule_wins(spark):
    df = spark.createDataFrame([("A3", "m"), ("A3", "x"), ("Adam", "x"), ("Adam", None), ("Adam", "k")], "login string, sex string")
    rules = [(-20002, checks.length_ok(F.col("login"), 20, 3)), (-20003, checks.in_domain(F.col("sex"), ["k", "m"]))]
    assert [r.code for r in quality.validated(df, rules).collect()] == [-20002, -20002, -20003, None, None]
    good, bad = quality.split_valid(df, rules)
    assert (good.count(), bad.count()) == (2, 3)
    report = quality.reject_report(quality.validated(df, rules), {-20002: "short", -20003: "sex"})
    assert {tuple(r) for r in report.collect()} == {(-20002, 2, "short"), (-20003, 1, "sex")}


def test_draws_cover_their_range(spark):
    got = [r[0] for r in spark.range(2000).select(draws.draw(F.col("id"), "x", 1, 3, 8)).distinct().collect()]
    assert sorted(got) == [3, 4, 5, 6, 7]


def test_people_and_offices(spark):
    offices, people = synth.offices(spark, 2000, 1), synth.persons(spark, 2000, 20_000, 1)
    assert offices.count() == offices.select("ADR_KOD_POCZTOWY").distinct().count() == 2000
    assert offices.where(~checks.format_ok(F.col("ADR_KOD_POCZTOWY"), checks.POSTCODE_FORMAT)).count() == 0
    assert people.select("OSO_NIP").distinct().count() == people.count() == 20_000
    assert people.where(~checks.nip_ok(F.col("OSO_NIP"))).count() == 0
    assert quality.unresolved(people, "ADR_ID", offices, "ADRK_1_ID").count() == 0
    men = people.where("OSO_PLEC = 'm'")
    assert men.where(~F.col("OSO_IMIE").isin(synth.MALE_NAMES)).count() == 0
    assert 9000 < men.count() < 11_000
    low, high = people.agg(F.min("OSO_DATA_URODZENIA"), F.max("OSO_DATA_URODZENIA")).first()
    assert dt.date(1900, 1, 1) <= low and high <= dt.date(1994, 12, 31)


def test_people_do_not_depend_on_partitions(spark):
    few = synth.persons_for(spark.range(0, 500, 1, 2), "id", 50, 3)
    many = synth.persons_for(spark.range(0, 500, 1, 31).repartition(7), "id", 50, 3)
    assert few.exceptAll(many).count() == 0
    assert few.exceptAll(synth.persons_for(spark.range(500), "id", 50, 4)).count() > 0


def test_office_limits(spark):
    with pytest.raises(ValueError):
        synth.offices(spark, synth.POSTCODES + 1, 1)
    assert synth.office_count(synth.POSTCODES + 1, shrink=True) == synth.POSTCODES // 2
    far = spark.range(synth.NIP_CAPACITY - 1, synth.NIP_CAPACITY + 1)
    assert [r.nip is None for r in synth.with_nip(far, "id", "nip").orderBy("id").collect()] == [False, True]


def test_large_row_numbers_give_unique_numbers(spark):
    rows = spark.range(5).select((F.col("id") * synth.NIP_PREFIXES + 7).alias("n"))
    got = [r.nip for r in synth.with_nip(rows, "n", "nip").collect()]
    assert len(set(got)) == 5 and len({g[:8] for g in got}) == 1


def test_some_people_move(spark):
    from tablespan.operators.changes import reassign_some

    before = synth.persons(spark, 2000, 20_000, 1)
    after = reassign_some(before, "OSOK_1_ID", "ADR_ID", "OSO_IMIE", "OSO_PLEC", 1000, [1, 2, 3], "Marek", 5)
    assert after.columns == before.columns
    moved = after.join(before.select("OSOK_1_ID", F.col("ADR_ID").alias("old")), "OSOK_1_ID").where("ADR_ID <> old")
    assert 850 < moved.count() < 1150
    assert after.where("OSO_IMIE = 'Marek' AND OSO_PLEC = 'k'").count() == 0


def test_sampled_profile(spark):
    from tablespan.operators.profile import sampled_profile

    df = spark.range(10_000).select((F.col("id") % 10).alias("few"), F.col("id").alias("many"))
    got = {r.column_name: r for r in sampled_profile(df, ["few", "many"], 0.2, 1, ["many"]).collect()}
    assert abs(got["few"].num_rows_estimate - 10_000) < 800
    assert got["few"].num_distinct_at_least == 10 and got["many"].num_distinct_at_least == got["many"].sample_size


def test_join_selectivity_formula(spark):
    from tablespan.operators.profile import join_selectivity, table_profile

    a = spark.range(594).toDF("a")
    b = spark.range(1943).toDF("b")
    assert join_selectivity(a, "a", b, "b").first()[0] == round(1 / 1943, 10)
    at = dt.datetime(2024, 1, 1)
    assert {tuple(r) for r in table_profile({"a": a, "b": b}, at).collect()} == {("a", 594, 594, at), ("b", 1943, 1943, at)}


def test_scratch_tables_use_the_shared_folder(spark):
    from tablespan import scratch

    setting = spark.conf.get(scratch.CHECKPOINT_SETTING, None)
    path = scratch.new_path(spark, "x")
    assert path.startswith((setting or scratch._own_folder()).rstrip("/"))
    assert path != scratch.new_path(spark, "x")
    assert scratch.table_or_empty(spark, path, spark.range(1).schema).count() == 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tablespan import scratch

    def session(master, folder):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda *_: folder))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError):
            scratch.shared_folder(session(master, None))
        assert scratch.shared_folder(session(master, "hdfs:///x/")) == "hdfs:///x"
    assert scratch.shared_folder(session("local[8]", None)) == scratch._own_folder()
