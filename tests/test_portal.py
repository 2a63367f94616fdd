"""The portal queries on the seed rows, with known answers."""

from pyspark.sql import functions as F

from tablespan.functions import arrays
from tablespan.operators import changes, hierarchy, nested, quality, relational as rel
from tablespan.sources import portal as schema
from tests.seed import BATCH_TIME


def values(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


def test_users_with_city_in_login_order(portal):
    u, m = portal["UZYTKOWNICY"], portal["MIASTO"]
    df = u.join(m, u.MIA_ID == m.MIAK_1_ID, "left").orderBy("UZY_LOGIN")
    assert values(df, "UZY_LOGIN", "MIA_MIASTO") == [("Michal87", "Warszawa"), ("Ola90", "Kraków")]


def test_youngest_users(portal):
    u, m = portal["UZYTKOWNICY"], portal["MIASTO"]
    joined = u.join(m, u.MIA_ID == m.MIAK_1_ID)
    top = rel.top_rows(joined, [F.desc("UZY_DATA_URODZENIA"), F.asc("UZYK_1_ID")], 3)
    got = [(r.UZY_LOGIN, r.UZY_DATA_URODZENIA.strftime("%Y-%m-%d"), r.MIA_MIASTO) for r in top.collect()]
    assert got == [("Ola90", "1990-05-09", "Kraków"), ("Michal87", "1987-02-22", "Warszawa")]


def test_every_category_with_its_books(portal):
    k = portal["KATEGORIE_KSIAZEK"].select("KATK_1_ID", "KAT_NAZWA")
    df = rel.keep_empty_join(k, "KATK_1_ID", portal["KSIAZKI"].select("KAT_ID", "KSI_TYTUL"), "KAT_ID")
    rows = values(df, "KAT_NAZWA", "KSI_TYTUL")
    assert len(rows) == 17  # 7 books and 10 empty categories
    assert ("Hacking", None) in rows and ("Powieść", "Dziady") in rows


def test_books_per_category(portal):
    df = rel.child_counts(portal["KATEGORIE_KSIAZEK"], "KATK_1_ID", portal["KSIAZKI"], "KAT_ID", "n")
    assert dict(values(df, "KATK_1_ID", "n")) == {i: {7: 4, 8: 1, 9: 1, 11: 1}.get(i, 0) for i in range(1, 15)}


def test_author_counts_follow_the_links(portal):
    assert dict(values(portal["AUTORZY"], "AUTK_1_ID", "AUT_LICZBA_KSIAZEK")) == {1: 4, 2: 2, 3: 3, 4: 2}
    top = rel.top_rows(portal["AUTORZY"], [F.desc("AUT_LICZBA_KSIAZEK"), F.asc("AUTK_1_ID")], 1)
    assert values(top, "AUT_LICZBA_KSIAZEK") == [4]
    some = (portal["AUTORZY"].where(F.col("AUT_LICZBA_KSIAZEK").between(2, 5))
            .orderBy(F.desc("AUT_LICZBA_KSIAZEK"), "AUTK_1_ID"))
    assert values(some, "AUT_NAZWISKO") == ["Mickiewicz", "Nowak", "Poeta", "Gates"]


def test_one_word_titles(portal):
    assert values(portal["KSIAZKI"].where(~F.col("KSI_TYTUL").like("% %")), "KSI_TYTUL") == ["Dziady"]


def test_title_search(portal):
    assert sorted(values(rel.search_titles(portal["KSIAZKI"], "KSI_TYTUL", "aw"), "KSI_TYTUL")) == [
        "Powieść prawdziwa", "Wielka wyprawa w kosmos"]
    assert values(rel.search_titles(portal["KSIAZKI"], "KSI_TYTUL", "waLL"), "KSI_TYTUL") == ["Konrad Wallenrod"]
    assert values(rel.search_titles(portal["KSIAZKI"], "KSI_TYTUL", "%"), "KSI_TYTUL") == []


def test_authors_in_subcategories(portal):
    df = rel.semi_chain(portal["AUTORZY"], [
        rel.Level("AUTK_1_ID", portal["AUK_AUTORZY_KSIAZKI"], "AUT_ID"),
        rel.Level("KSI_ID", portal["KSIAZKI"], "KSIK_1_ID", unique=True),
        rel.Level("KAT_ID", portal["KATEGORIE_KSIAZEK"].where("KAT_RODZIC_KATEGORII = 1"), "KATK_1_ID")])
    assert values(df.orderBy("AUT_IMIE"), "AUT_IMIE") == ["Adam", "Jan", "John", "Marek"]


def test_categories_of_one_author(portal):
    nowak = portal["AUTORZY"].where("AUT_IMIE = 'Marek' AND AUT_NAZWISKO = 'Nowak'")
    df = rel.semi_chain(portal["KATEGORIE_KSIAZEK"], [
        rel.Level("KATK_1_ID", portal["KSIAZKI"], "KAT_ID"),
        rel.Level("KSIK_1_ID", portal["AUK_AUTORZY_KSIAZKI"], "KSI_ID"),
        rel.Level("AUT_ID", nowak, "AUTK_1_ID", unique=True)]).select("KAT_NAZWA").distinct()
    assert sorted(values(df, "KAT_NAZWA")) == ["Historyczne", "Popularnonaukowe", "Powieść"]


def test_category_tree_listing(portal):
    tree = hierarchy.walk(portal["KATEGORIE_KSIAZEK"], "KATK_1_ID", "KAT_RODZIC_KATEGORII").orderBy("sort_path")
    assert values(tree, hierarchy.indented(F.col("KAT_NAZWA"))) == [
        "- Literatura", "--- Powieść", "--- Historyczne", "--- Popularnonaukowe", "- Edukacja", "- Informatyka",
        "--- Bazy danych", "--- Programowanie", "----- Programowanie obiektowe", "----- Programowanie proceduralne",
        "--- Hacking", "- Biznes", "- Zdrowie", "- Podręczniki"]


def favourites(portal, login):
    user = portal["UZYTKOWNICY"].where(F.col("UZY_LOGIN") == login).select("UZYK_1_ID").scalar()
    return rel.semi_chain(portal["KSIAZKI"], [
        rel.Level("KSIK_1_ID", portal["ULUBIONE_KSIAZKI"].where(F.col("UZY_ID") == user), "KSI_ID")])


def named_links(portal):
    links, authors = portal["AUK_AUTORZY_KSIAZKI"], portal["AUTORZY"]
    return links.join(authors, links.AUT_ID == authors.AUTK_1_ID).select(
        "KSI_ID", "AUT_ID", F.struct("AUT_IMIE", "AUT_NAZWISKO").alias("autor"))


def test_favourites_with_authors_nested(portal):
    df = nested.nest_under(favourites(portal, "Ola90").select("KSIK_1_ID", "KSI_TYTUL"), "KSIK_1_ID",
                           named_links(portal), "KSI_ID", ["autor"], ["AUT_ID"], "autorzy")
    got = {r.KSI_TYTUL: [a.autor.AUT_NAZWISKO for a in r.autorzy] for r in df.collect()}
    assert got == {"Pan Tadeusz": ["Mickiewicz", "Nowak", "Gates"], "Programowanie w C++": ["Poeta", "Gates"],
                   "Dziady": ["Mickiewicz"], "Wielka wyprawa w kosmos": ["Mickiewicz", "Nowak"]}


def test_favourites_with_author_slots(portal):
    slots = nested.slots(named_links(portal), ["KSI_ID"], ["AUT_ID"], "autor", 3, "autor")
    df = favourites(portal, "Ola90").join(slots, F.col("KSIK_1_ID") == F.col("KSI_ID"), "left")
    got = {r[0]: r[1:] for r in values(df, "KSI_TYTUL", "autor1.AUT_IMIE", "autor2.AUT_IMIE", "autor3.AUT_IMIE")}
    assert got["Pan Tadeusz"] == ("Adam", "Marek", "John")
    assert got["Dziady"] == ("Adam", None, None)


def test_rated_books_per_user(portal):
    u, o = portal["UZYTKOWNICY"], portal["OCENY_KSIAZEK"]
    counts = u.join(o, u.UZYK_1_ID == o.UZY_ID, "right").groupBy("UZY_LOGIN").agg(F.count("*").alias("n"))
    assert dict(values(counts, "UZY_LOGIN", "n")) == {"Ola90": 3, "Michal87": 3}
    one_map = nested.count_map(u.join(o, u.UZYK_1_ID == o.UZY_ID, "right").withColumn("all", F.lit(1)), ["all"], "UZY_LOGIN")
    assert values(one_map, "counts") == [{"Ola90": 3, "Michal87": 3}]


def test_titles_per_author(portal):
    links, books = portal["AUK_AUTORZY_KSIAZKI"], portal["KSIAZKI"]
    titles = books.join(links, books.KSIK_1_ID == links.KSI_ID, "right").select("AUT_ID", "KSI_ID", "KSI_TYTUL")
    df = nested.nest_under(portal["AUTORZY"].select("AUTK_1_ID"), "AUTK_1_ID", titles, "AUT_ID",
                           ["KSI_TYTUL"], ["KSI_ID"], "ksiazki")
    got = {r.AUTK_1_ID: [k.KSI_TYTUL for k in r.ksiazki] for r in df.collect()}
    assert got == {1: ["Pan Tadeusz", "Dziady", "Konrad Wallenrod", "Wielka wyprawa w kosmos"],
                   2: ["Powieść prawdziwa", "Programowanie w C++"],
                   3: ["Pan Tadeusz", "Wielka wyprawa w kosmos", "Super książka 2"],
                   4: ["Pan Tadeusz", "Programowanie w C++"]}


def test_delete_marks_by_text(portal):
    marks = portal["OCENY_KSIAZEK"]

    def removed(df, text):
        kept, report = changes.delete_where(df, text)
        return kept, report.first()["removed"]

    kept, n = removed(marks, "UZY_ID = 1 AND OCE_OCENA <= 4.0")
    assert n == 2
    kept, n = removed(kept, "UZY_ID = 99999")
    assert n == 0
    kept, n = removed(kept, "1=1")
    assert (n, kept.count()) == (4, 0)


def test_users_liking_exactly_these_genres(portal):
    wanted = F.array(*[F.lit(g) for g in ("Kryminały", "Romanse", "Thriller")])
    df = portal["GATUNKI_ULUBIONE"].where(arrays.same_elements(F.col("GAT_GATUNKI"), wanted))
    assert values(df, "UZY_ID") == [2]


def test_genre_updates(portal, spark):
    changes_ = spark.createDataFrame(
        [(1, ["Kryminały", "Horrory", "Historyczne"], "_DOPISZ_"), (2, ["Biografie", "Romanse"], "_NADPISZ_")],
        "k long, extra array<string>, mode string")
    df = portal["GATUNKI_ULUBIONE"].join(changes_, F.col("UZY_ID") == F.col("k"), "left").select(
        "UZY_ID", arrays.updated(F.col("GAT_GATUNKI"), F.col("extra"), F.col("mode")).alias("g"))
    assert dict(values(df, "UZY_ID", "g")) == {
        1: ["Kryminały", "Science fiction", "Horrory", "Historyczne"], 2: ["Biografie", "Romanse"]}


def test_publishers_by_city_with_books(portal):
    w, m = portal["WYDAWNICTWO"], portal["MIASTO"]
    e, link, b = portal["WERSJA_WYDANIA"], portal["WERSJE_WYDANIA_KSIAZEK"], portal["KSIAZKI"]
    df = (w.join(m, w.MIA_ID == m.MIAK_1_ID, "left").join(e, w.WYDK_1_ID == e.WYD_ID, "left")
          .join(link, e.WERK_1_ID == link.WER_ID, "left").join(b, link.KSI_ID == b.KSIK_1_ID, "left"))
    assert set(values(df, "WYD_NAZWA_WYDAWNICTWA", "MIA_MIASTO", "KSI_TYTUL")) == {
        ("PWN", "Warszawa", "Pan Tadeusz"), ("KrakMedia", "Kraków", None)}


def test_author_lines_mention_death_only_when_known(portal):
    died = F.when(F.col("AUT_ROK_SMIERCI").isNull(), "").otherwise(
        F.concat(F.lit(" zm. "), F.date_format("AUT_ROK_SMIERCI", "yyyy/MM/dd")))
    line = F.concat(F.col("AUT_NAZWISKO"), F.lit(" (ur. "), F.date_format("AUT_ROK_URODZENIA", "yyyy/MM/dd"), died, F.lit(")"))
    assert values(portal["AUTORZY"].orderBy("AUT_NAZWISKO"), line) == [
        "Gates (ur. 1959/06/20)", "Mickiewicz (ur. 1798/12/24 zm. 1855/11/26)", "Nowak (ur. 1968/07/30)",
        "Poeta (ur. 1898/02/12 zm. 1951/10/01)"]


def test_seed_rows_satisfy_every_contract(portal):
    # insert times of sessions are not part of the seed; all other declared rules hold
    for contract in schema.PORTAL:
        report = quality.audit_contract(portal, contract).where("violations > 0").collect()
        assert report == [], (contract.name, report)


def test_insert_time_is_set_by_the_batch(portal):
    assert {r[0] for r in portal["KSIAZKI"].select("KSI_DODANO").collect()} == {BATCH_TIME}


def test_largest_birth_date_of_administrators(portal):
    got = portal["UZYTKOWNICY"].where("UZY_CZY_ADMIN = '1'").agg(F.max("UZY_DATA_URODZENIA").alias("d")).first()
    assert got["d"].year == 1990
