"""Headline timings as one JSON line. Each job runs three times and the shortest is reported, so
session start and code generation are not part of it. Rows are consumed by Spark's `noop` sink."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = [
    "filter_eq_conj", "filter_prefix_date", "predicate_selectivity", "join_filter_count", "join_key_range",
    "books_per_category", "nested_in_4", "count_in_top3", "join_hints_agree", "within_years_of_mean",
    "outer_plus_keep_empty", "running_count", "authors_nested", "upsert_dim", "assign_ids", "validate_report",
    "column_profile", "equi_height_histogram", "tree_depth", "stream_counter",
]


def recorded_counts(spark) -> dict:
    from pyspark.sql import functions as F

    from tablespan.operators import synth
    from tablespan.scratch import written_table

    offices = written_table(synth.offices(spark, 2000, 1), "bench-offices")
    people = written_table(synth.persons(spark, 2000, 1_000_000, 1), "bench-persons")
    named, man = F.col("OSO_IMIE") == synth.MALE_NAMES[0], F.col("OSO_PLEC") == "m"
    city = F.col("ADR_MIASTO") == synth.CITIES[0]
    placed = people.join(offices, F.col("ADR_ID") == F.col("ADRK_1_ID"))
    prefix = F.col("OSO_NAZWISKO").startswith("B") & F.col("OSO_DATA_URODZENIA").between("1950-01-01", "1954-12-31")
    rows = {"q1_name_sex": people.where(named & man), "q2_name_city": placed.where(named & city), "q3_sex_city": placed.where(man & city),
            "q4_sex": people.where(man), "q5_prefix_date": people.where(prefix)}
    return {f"recorded_{name}": (lambda df=df: df.agg(F.count("*").alias("n"))) for name, df in rows.items()}


def main() -> None:
    from tablespan.operators import synth
    from tablespan.plans import JOBS
    from tablespan.session import build_session

    with contextlib.redirect_stdout(sys.stderr):
        spark = build_session(f"local[{CPUS}]", int(CPUS), app="bench", **{"spark.driver.memory": "8g"})
        spark.sparkContext.setLogLevel("ERROR")
        runs = {name: (lambda name=name: JOBS[name](spark, FOLDER)) for name in QUERIES}
        runs["generate_2000_offices"] = lambda: synth.offices(spark, 2000, 1)
        runs["generate_1000000_persons"] = lambda: synth.persons(spark, 2000, 1_000_000, 1)
        runs |= recorded_counts(spark)
        seconds = {}
        for name, run in runs.items():
            times = []
            for _ in range(3):
                start = time.perf_counter()
                run().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            seconds[name] = round(min(times), 3)
            print(name, seconds[name])
        spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
