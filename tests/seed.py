"""The book-portal seed rows, as frames by table name.

Fixed values: ids, parent keys, names, titles, links, marks and dates, which the expected results
in the tests refer to. The two users' logins, e-mails and digests are our own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablespan.operators import changes
from tablespan.sources import portal
from tablespan.sources.contracts import aligned, rows_frame

BATCH_TIME = dt.datetime(2024, 3, 1, 12, 0, 0)


def day(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y/%m/%d")


ROWS = {
    "MIASTO": [
        dict(MIA_MIASTO="Kraków", MIA_WSPOLRZEDNE="52.025459,19.204102"),
        dict(MIA_MIASTO="Warszawa", MIA_WSPOLRZEDNE="50.070362,19.944992"),
    ],
    "UZYTKOWNICY": [
        dict(UZY_LOGIN="Ola90", UZY_HASLO_HASH="a" * 40, UZY_STATUS="1", UZY_CZY_ADMIN="1", UZY_IMIE="Ola",
             UZY_PLEC="m", UZY_DATA_URODZENIA=day("1990/05/09"), UZY_EMAIL="ola90@poczta.pl", MIA_ID=1),
        dict(UZY_LOGIN="Michal87", UZY_HASLO_HASH="b" * 40, UZY_STATUS="1", UZY_CZY_ADMIN="0", UZY_IMIE="Michał",
             UZY_PLEC="m", UZY_DATA_URODZENIA=day("1987/02/22"), UZY_EMAIL="michal87@poczta.pl", MIA_ID=2),
    ],
    "KATEGORIE_KSIAZEK": [
        dict(KAT_NAZWA="Literatura"),
        dict(KAT_NAZWA="Edukacja"),
        dict(KAT_NAZWA="Informatyka"),
        dict(KAT_NAZWA="Biznes"),
        dict(KAT_NAZWA="Zdrowie"),
        dict(KAT_NAZWA="Podręczniki"),
        dict(KAT_NAZWA="Powieść", KAT_RODZIC_KATEGORII=1),
        dict(KAT_NAZWA="Historyczne", KAT_RODZIC_KATEGORII=1),
        dict(KAT_NAZWA="Popularnonaukowe", KAT_RODZIC_KATEGORII=1),
        dict(KAT_NAZWA="Bazy danych", KAT_RODZIC_KATEGORII=3),
        dict(KAT_NAZWA="Programowanie", KAT_RODZIC_KATEGORII=3),
        dict(KAT_NAZWA="Hacking", KAT_RODZIC_KATEGORII=3),
        dict(KAT_NAZWA="Programowanie obiektowe", KAT_RODZIC_KATEGORII=11),
        dict(KAT_NAZWA="Programowanie proceduralne", KAT_RODZIC_KATEGORII=11),
    ],
    "AUTORZY": [
        dict(UZY_ID=1, AUT_IMIE="Adam", AUT_NAZWISKO="Mickiewicz", AUT_ROK_URODZENIA=day("1798/12/24"),
             AUT_ROK_SMIERCI=day("1855/11/26"), AUT_BIOGRAFIA="poeta"),
        dict(UZY_ID=1, AUT_IMIE="Jan", AUT_NAZWISKO="Poeta", AUT_ROK_URODZENIA=day("1898/02/12"),
             AUT_ROK_SMIERCI=day("1951/10/01"), AUT_BIOGRAFIA="poeta"),
        dict(UZY_ID=2, AUT_IMIE="Marek", AUT_NAZWISKO="Nowak", AUT_ROK_URODZENIA=day("1968/07/30"),
             AUT_BIOGRAFIA="pisarz"),
        dict(UZY_ID=1, AUT_IMIE="John", AUT_NAZWISKO="Gates", AUT_ROK_URODZENIA=day("1959/06/20"),
             AUT_BIOGRAFIA="informatyk"),
    ],
    "KSIAZKI": [
        dict(UZY_ID=1, KAT_ID=7, KSI_TYTUL="Pan Tadeusz"),
        dict(UZY_ID=1, KAT_ID=7, KSI_TYTUL="Dziady"),
        dict(UZY_ID=1, KAT_ID=7, KSI_TYTUL="Konrad Wallenrod"),
        dict(UZY_ID=2, KAT_ID=7, KSI_TYTUL="Powieść prawdziwa"),
        dict(UZY_ID=2, KAT_ID=9, KSI_TYTUL="Wielka wyprawa w kosmos"),
        dict(UZY_ID=1, KAT_ID=11, KSI_TYTUL="Programowanie w C++"),
        dict(UZY_ID=2, KAT_ID=8, KSI_TYTUL="Super książka 2"),
    ],
    "AUK_AUTORZY_KSIAZKI": [dict(AUT_ID=a, KSI_ID=k) for a, k in [
        (1, 1), (1, 2), (1, 3), (2, 4), (3, 5), (4, 6), (3, 7), (3, 1), (4, 1), (2, 6), (1, 5)]],
    "OCENY_KSIAZEK": [dict(UZY_ID=u, KSI_ID=k, OCE_OCENA=o) for u, k, o in [
        (1, 3, "4.0"), (1, 1, "4.5"), (1, 7, "2.5"), (2, 1, "5.0"), (2, 2, "4.0"), (2, 4, "1.5")]],
    "ULUBIONE_KSIAZKI": [dict(UZY_ID=u, KSI_ID=k) for u, k in [
        (1, 2), (1, 6), (1, 1), (1, 5), (2, 2), (2, 4), (2, 5)]],
    "WYDAWNICTWO": [
        dict(WYD_NAZWA_WYDAWNICTWA="PWN", MIA_ID=2, WYD_ULICA="Kolorowa 12", WYD_TELEFON="1", WYD_EMAIL="a@pwn.pl"),
        dict(WYD_NAZWA_WYDAWNICTWA="KrakMedia", MIA_ID=1, WYD_ULICA="Krakowska 102", WYD_TELEFON="2",
             WYD_EMAIL="b@km.pl"),
    ],
    "WERSJA_WYDANIA": [dict(WYD_ID=1, WER_OPIS="Książka", WER_ROK_WYDANIA=day("2008/01/01"), WER_ISBN="9788374356596")],
    "WERSJE_WYDANIA_KSIAZEK": [dict(KSI_ID=1, WER_ID=1, UZY_ID=2)],
    "GATUNKI_ULUBIONE": [
        dict(UZY_ID=1, GAT_GATUNKI=["Kryminały", "Science fiction"]),
        dict(UZY_ID=2, GAT_GATUNKI=["Romanse", "Thriller", "Kryminały"]),
    ],
}


def load(spark) -> dict:
    """Rows with ids in insertion order, insert times, and author book counts kept from the links."""
    from decimal import Decimal

    frames = {}
    for contract in portal.PORTAL:
        rows = []
        for number, row in enumerate(ROWS.get(contract.name, []), start=1):
            row = dict(row)
            if len(contract.key) == 1 and contract.key[0] not in row:
                row[contract.key[0]] = number
            if "OCE_OCENA" in row:
                row["OCE_OCENA"] = Decimal(row["OCE_OCENA"])
            rows.append(row)
        df = rows_frame(spark, contract, rows)
        for c in contract.columns:
            if c.name.endswith(("_DODANO", "_DOLACZYL")):
                df = changes.stamp(df, c.name, BATCH_TIME)
        frames[contract.name] = aligned(df, contract)
    frames["AUTORZY"] = changes.maintained_counts(
        frames["AUTORZY"], "AUTK_1_ID", "AUT_LICZBA_KSIAZEK", frames["AUK_AUTORZY_KSIAZKI"], "AUT_ID")
    return {name: df.select(*[F.col(c) for c in df.columns]) for name, df in frames.items()}
