"""Synthetic persons and post offices of any size.

Each field is a function of row id and seed, so rows are made independently, in parallel, and the
same whatever the partitioning. Uniqueness comes from one-to-one maps of the row id, not from
looking up what was made before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablespan.functions.checks import NIP_WEIGHTS
from tablespan.functions.draws import draw, draw_from
from tablespan.operators.ordinals import running_total
from tablespan.scratch import written_table

# small value pools of our own
MALE_NAMES = ["Adam", "Bartek", "Cezary", "Daniel", "Emil", "Filip", "Grzegorz", "Hubert", "Igor",
              "Jakub", "Karol", "Leon", "Marcin", "Norbert", "Oskar", "Piotr", "Robert", "Szymon"]
FEMALE_NAMES = ["Alicja", "Beata", "Celina", "Dorota", "Ewa", "Felicja", "Gabriela", "Hanna", "Iga",
                "Julia", "Kinga", "Laura", "Magda", "Natalia", "Olga", "Paulina", "Renata", "Sylwia"]
SURNAMES = ["Baran", "Czajka", "Dudek", "Filipek", "Gajda", "Jagoda", "Kania", "Lis", "Mazur",
            "Niemiec", "Olszewik", "Pawlik", "Rak", "Sikora", "Topola", "Urban", "Wilk", "Zawada"]
STREETS = ["Akacjowa", "Brzozowa", "Cicha", "Dworcowa", "Graniczna", "Jesionowa", "Klonowa",
           "Lipowa", "Nowa", "Ogrodowa", "Parkowa", "Rynek", "Szkolna", "Topolowa", "Wodna"]
CITIES = ["Bochnia", "Chorzów", "Elbląg", "Gdynia", "Jarosław", "Kraków", "Leszno", "Mielec",
          "Nysa", "Opole", "Puck", "Rybnik", "Sopot", "Tarnów", "Ustka", "Wieliczka", "Zamość"]

POSTCODES = 100_000          # 00-000 .. 99-999
NIP_PREFIXES = 100_000_000   # eight free digits
NIP_CAPACITY = 5 * NIP_PREFIXES

# multipliers without a factor 2 or 5 permute the numbers below a power of ten
NIP_STEP, NIP_SHIFT = 48_271_037, 12_345_678
POSTCODE_STEP, POSTCODE_SHIFT = 61_283, 30_001

FIRST_DAY, DAYS = "1900-01-01", 34_698  # up to 1994-12-31


def digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def with_nip(rows: DataFrame, row_no: str, name: str) -> DataFrame:
    """Add a valid ten-digit number for each row number from 0 below NIP_CAPACITY, all different; no
    more exist of this form, so rows beyond have none (NULL). Eight digits are a
    permutation of the row number; the ninth is the one of a pair (0/1, 2/3, ...) that leaves a
    check digit below 10, which at least one of the two does. Built in steps, each a short
    expression over the columns of the one before."""
    row = F.when(F.col(row_no) < NIP_CAPACITY, F.col(row_no))
    weighted = " + ".join(f"{w} * (_prefix div {10 ** (7 - i)} % 10)" for i, w in enumerate(NIP_WEIGHTS[:8]))
    last = NIP_WEIGHTS[8]
    return (rows
            .withColumn("_row", row)
            .withColumn("_prefix", F.expr(f"(_row % {NIP_PREFIXES} * {NIP_STEP} + {NIP_SHIFT}) % {NIP_PREFIXES}"))
            .withColumn("_sum", F.expr(weighted))
            .withColumn("_ninth", F.expr(f"_row div {NIP_PREFIXES} * 2"))
            .withColumn("_ninth", F.expr(f"_ninth + if((_sum + {last} * _ninth) % 11 = 10, 1, 0)"))
            .withColumn(name, F.concat(digits(F.col("_prefix"), 8), F.col("_ninth").cast("string"),
                                       F.expr(f"string((_sum + {last} * _ninth) % 11)")))
            .drop("_row", "_prefix", "_sum", "_ninth"))


def postcode(row_no: Column) -> Column:
    number = digits((row_no * POSTCODE_STEP + POSTCODE_SHIFT) % POSTCODES, 5)
    return F.concat(F.substring(number, 1, 2), F.lit("-"), F.substring(number, 3, 3))


def flat_number(row_id: Column, salt: str, seed: int) -> Column:
    return F.concat_ws("/", draw(row_id, salt + " house", seed, 1, 100).cast("string"),
                       draw(row_id, salt + " flat", seed, 1, 100).cast("string"))


def birth_date(row_id: Column, seed: int) -> Column:
    """Every day of the range is possible, month lengths and leap years included."""
    return F.date_add(F.lit(FIRST_DAY).cast("date"), draw(row_id, "birth", seed, 0, DAYS).cast("int"))


def office_count(wanted: int, shrink: bool = False) -> int:
    """Postcodes are unique, so there are at most as many offices. With `shrink`, a larger request
    becomes half the pool; otherwise it is an error."""
    if wanted <= POSTCODES:
        return wanted
    if shrink:
        return POSTCODES // 2
    raise ValueError(f"only {POSTCODES} postcodes for {wanted} offices")


def offices(spark: SparkSession, count: int, seed: int, shrink: bool = False) -> DataFrame:
    row = F.col("id")
    return spark.range(office_count(count, shrink)).select(
        (row + 1).alias("ADRK_1_ID"),
        draw_from(row, "city", seed, CITIES).alias("ADR_MIASTO"),
        postcode(row).alias("ADR_KOD_POCZTOWY"),
        draw_from(row, "street", seed, STREETS).alias("ADR_ULICA"),
        flat_number(row, "office", seed).alias("ADR_NR_LOKALU"))


def persons_for(rows: DataFrame, row_no: str, office_total: int | Column, seed: int) -> DataFrame:
    """One person per input row; `row_no` counts from 0 and is unique."""
    row = F.col(row_no)
    sex = F.when(draw(row, "sex", seed, 0, 2) == 0, F.lit("m")).otherwise(F.lit("k"))
    name = F.when(F.col("OSO_PLEC") == "m", draw_from(row, "male", seed, MALE_NAMES)).otherwise(
        draw_from(row, "female", seed, FEMALE_NAMES))
    return with_nip(rows, row_no, "OSO_NIP").withColumn("OSO_PLEC", sex).select(
        (row + 1).alias("OSOK_1_ID"),
        name.alias("OSO_IMIE"),
        draw_from(row, "surname", seed, SURNAMES).alias("OSO_NAZWISKO"),
        "OSO_PLEC",
        birth_date(row, seed).alias("OSO_DATA_URODZENIA"),
        F.lit(None).cast("string").alias("OSO_PESEL"),
        "OSO_NIP",
        draw_from(row, "street", seed, STREETS).alias("OSO_ULICA"),
        flat_number(row, "person", seed).alias("OSO_NR_LOKALU"),
        (draw(row, "office", seed, 0, office_total) + 1).alias("ADR_ID"))


def persons(spark: SparkSession, office_total: int, count: int, seed: int) -> DataFrame:
    return persons_for(spark.range(count), "id", office_total, seed)


def drawn_without_repeats(pool: DataFrame, value: str, takers: DataFrame, taker: str,
                          seed: str, **sampling) -> DataFrame:
    """Give each taker a different pool value, in an order shuffled by `seed`. Takers beyond the
    pool's size get NULL.

    The order is that of a hash, and only its first rows are drawn: as many as there are takers. Hashes are spread
    evenly, so those lie below a limit that is known from the two sizes, and rows above it are dropped where they are
    read. Should too few lie below it, the limit is doubled."""
    hashed = pool.select(F.md5(F.concat_ws("|", F.col(value).cast("string"), F.lit(seed))).alias("_mix"), value)
    pool_rows, wanted = pool.count(), takers.count()
    wanted = min(pool_rows, wanted)
    share = (wanted + 6 * wanted ** 0.5 + 20) / max(1, pool_rows)
    while True:
        low = hashed if share >= 1 else hashed.where(F.col("_mix") < f"{int(share * 16 ** 12):012x}")
        low = written_table(low, "drawn")
        if share >= 1 or low.count() >= wanted:
            break
        share *= 2
    ranked = running_total(low, [], ["_mix", value], "_rank", **sampling).where(F.col("_rank") <= wanted).drop("_mix")
    queue = running_total(takers.select(taker), [], [taker], "_rank", **sampling)
    return queue.join(ranked, "_rank", "left").select(taker, value)
