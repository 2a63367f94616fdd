"""Contracts of the book-portal schema (18 tables) and of the person / post-office set (3 tables).

Table names, column names, lengths and defaults are fixed values: queries written for this schema
must find the same names."""

from __future__ import annotations

from tablespan.sources.contracts import Contract, column, refers

MIASTO = Contract("MIASTO", [
    column("MIAK_1_ID", "long"),
    column("MIA_MIASTO", "text", 100),
    column("MIA_WSPOLRZEDNE", "text", 254, nullable=True),
], key=("MIAK_1_ID",))

UZYTKOWNICY = Contract("UZYTKOWNICY", [
    column("UZYK_1_ID", "long"),
    column("UZY_LOGIN", "text", 20),
    column("UZY_HASLO_HASH", "text", 40),
    column("UZY_STATUS", "text", 1),
    column("UZY_CZY_ADMIN", "text", 1),
    column("UZY_IMIE", "text", 30, nullable=True),
    column("UZY_PLEC", "text", 1, nullable=True),
    column("UZY_DATA_URODZENIA", "ts", nullable=True),
    column("UZY_EMAIL", "text", 100),
    column("UZY_DOLACZYL", "ts"),
    column("MIA_ID", "long", nullable=True),
], key=("UZYK_1_ID",), unique=("UZY_LOGIN", "UZY_EMAIL"),
    references=(refers("MIA_ID", "MIASTO", "MIAK_1_ID"),),
    domains={"UZY_STATUS": ["0", "1"], "UZY_CZY_ADMIN": ["0", "1"], "UZY_PLEC": ["k", "m"]})

SESJE_UZYTKOWNIKOW = Contract("SESJE_UZYTKOWNIKOW", [
    column("SESK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("SES_KLUCZ", "text", 40),
    column("SES_IP", "text", 100, nullable=True),
    column("SES_ZALOGOWANO", "ts"),
    column("SES_WAZNOSC", "ts"),
], key=("SESK_1_ID",), references=(refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),))

KATEGORIE_KSIAZEK = Contract("KATEGORIE_KSIAZEK", [
    column("KATK_1_ID", "long"),
    column("KAT_NAZWA", "text", 150),
    column("KAT_RODZIC_KATEGORII", "long", nullable=True),
], key=("KATK_1_ID",),
    references=(refers("KAT_RODZIC_KATEGORII", "KATEGORIE_KSIAZEK", "KATK_1_ID"),))

AUTORZY = Contract("AUTORZY", [
    column("AUTK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("AUT_IMIE", "text", 100),
    column("AUT_NAZWISKO", "text", 150),
    column("AUT_PSEUDONIM", "text", 100, nullable=True),
    column("AUT_ROK_URODZENIA", "ts"),
    column("AUT_ROK_SMIERCI", "ts", nullable=True),
    column("AUT_BIOGRAFIA", "text"),
    column("AUT_LICZBA_KSIAZEK", "long", nullable=True, default=0),
], key=("AUTK_1_ID",), references=(refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),))

KSIAZKI = Contract("KSIAZKI", [
    column("KSIK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("KAT_ID", "long"),
    column("KSI_TYTUL", "text", 254),
    column("KSI_DODANO", "ts"),
], key=("KSIK_1_ID",), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KAT_ID", "KATEGORIE_KSIAZEK", "KATK_1_ID")))

AUK_AUTORZY_KSIAZKI = Contract("AUK_AUTORZY_KSIAZKI", [
    column("AUT_ID", "long"),
    column("KSI_ID", "long"),
], key=("AUT_ID", "KSI_ID"), references=(
    refers("AUT_ID", "AUTORZY", "AUTK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

CYTATY_Z_KSIAZEK = Contract("CYTATY_Z_KSIAZEK", [
    column("CYTK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("KSI_ID", "long"),
    column("CYT_CYTAT", "text"),
    column("CYT_DODANO", "ts"),
], key=("CYTK_1_ID",), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

OCENY_KSIAZEK = Contract("OCENY_KSIAZEK", [
    column("UZY_ID", "long"),
    column("KSI_ID", "long"),
    column("OCE_OCENA", "decimal(10,1)"),
], key=("UZY_ID", "KSI_ID"), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

ULUBIONE_KSIAZKI = Contract("ULUBIONE_KSIAZKI", [
    column("UZY_ID", "long"),
    column("KSI_ID", "long"),
    column("ULU_DODANO", "ts"),
], key=("UZY_ID", "KSI_ID"), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

ULA_ULUBIENI_AUTORZY = Contract("ULA_ULUBIENI_AUTORZY", [
    column("UZY_ID", "long"),
    column("AUT_ID", "long"),
    column("ULA_DODANO", "ts"),
], key=("UZY_ID", "AUT_ID"), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("AUT_ID", "AUTORZY", "AUTK_1_ID")))

RECENZJE_KSIAZEK = Contract("RECENZJE_KSIAZEK", [
    column("RECK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("KSI_ID", "long"),
    column("REC_TYTUL", "text", 254),
    column("REC_TRESC", "text"),
    column("REC_DODANO", "ts"),
], key=("RECK_1_ID",), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

KOMENTARZE_DO_RECENZJI = Contract("KOMENTARZE_DO_RECENZJI", [
    column("KOMK_1_ID", "long"),
    column("REC_ID", "long"),
    column("UZY_ID", "long"),
    column("KOM_KOMENTARZ", "text"),
    column("KOM_DODANO", "ts"),
], key=("KOMK_1_ID",), references=(
    refers("REC_ID", "RECENZJE_KSIAZEK", "RECK_1_ID"),
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID")))

OPINIE_DO_KSIAZEK = Contract("OPINIE_DO_KSIAZEK", [
    column("OPIK_1_ID", "long"),
    column("UZY_ID", "long"),
    column("KSI_ID", "long"),
    column("OPI_TRESC", "text"),
    column("OPI_DODANO", "ts"),
], key=("OPIK_1_ID",), references=(
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID")))

WYDAWNICTWO = Contract("WYDAWNICTWO", [
    column("WYDK_1_ID", "long"),
    column("WYD_NAZWA_WYDAWNICTWA", "text", 254),
    column("MIA_ID", "long"),
    column("WYD_ULICA", "text", 100),
    column("WYD_TELEFON", "text", 254),
    column("WYD_EMAIL", "text", 150),
], key=("WYDK_1_ID",), references=(refers("MIA_ID", "MIASTO", "MIAK_1_ID"),))

WERSJA_WYDANIA = Contract("WERSJA_WYDANIA", [
    column("WERK_1_ID", "long"),
    column("WYD_ID", "long"),
    column("WER_OPIS", "text"),
    column("WER_ROK_WYDANIA", "ts"),
    column("WER_ISBN", "text", 25),
    column("WER_OKLADKA", "binary", nullable=True),
], key=("WERK_1_ID",), references=(refers("WYD_ID", "WYDAWNICTWO", "WYDK_1_ID"),))

WERSJE_WYDANIA_KSIAZEK = Contract("WERSJE_WYDANIA_KSIAZEK", [
    column("KSI_ID", "long"),
    column("WER_ID", "long"),
    column("UZY_ID", "long"),
    column("WWK_DODANO", "ts", nullable=True),
], key=("KSI_ID", "WER_ID"), references=(
    refers("KSI_ID", "KSIAZKI", "KSIK_1_ID"),
    refers("WER_ID", "WERSJA_WYDANIA", "WERK_1_ID"),
    refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID")))

GATUNKI_ULUBIONE = Contract("GATUNKI_ULUBIONE", [
    column("UZY_ID", "long"),
    column("GAT_GATUNKI", "texts", 50, nullable=True),
], key=("UZY_ID",), references=(refers("UZY_ID", "UZYTKOWNICY", "UZYK_1_ID"),))

ADRES_POCZTY = Contract("ADRES_POCZTY", [
    column("ADRK_1_ID", "long"),
    column("ADR_MIASTO", "text", 100),
    column("ADR_KOD_POCZTOWY", "text", 6, nullable=True, default="00-000"),
    column("ADR_ULICA", "text", 100),
    column("ADR_NR_LOKALU", "text", 10, nullable=True, default="0/0"),
], key=("ADRK_1_ID",), unique=("ADR_KOD_POCZTOWY",))

OSOBY = Contract("OSOBY", [
    column("OSOK_1_ID", "long"),
    column("OSO_IMIE", "text", 50),
    column("OSO_NAZWISKO", "text", 50),
    column("OSO_PLEC", "text", 1),
    column("OSO_DATA_URODZENIA", "date"),
    column("OSO_PESEL", "text", 11, nullable=True),
    column("OSO_NIP", "text", 10, nullable=True),
    column("OSO_ULICA", "text", 100),
    column("OSO_NR_LOKALU", "text", 10, nullable=True, default="0/0"),
    column("ADR_ID", "long"),
], key=("OSOK_1_ID",), unique=("OSO_PESEL", "OSO_NIP"),
    references=(refers("ADR_ID", "ADRES_POCZTY", "ADRK_1_ID"),),
    domains={"OSO_PLEC": ["k", "m"]})

HELP_TABLE = Contract("HELP_TABLE", [
    column("HELK_1_ID", "long"),
    column("HEL_FIELD", "text", 100),
    column("HEL_TYPE", "long"),
], key=("HELK_1_ID",), domains={"HEL_TYPE": [0, 1, 2, 3, 4, 5]})

PORTAL = [
    MIASTO, UZYTKOWNICY, SESJE_UZYTKOWNIKOW, KATEGORIE_KSIAZEK, AUTORZY, KSIAZKI,
    AUK_AUTORZY_KSIAZKI, CYTATY_Z_KSIAZEK, OCENY_KSIAZEK, ULUBIONE_KSIAZKI,
    ULA_ULUBIENI_AUTORZY, RECENZJE_KSIAZEK, KOMENTARZE_DO_RECENZJI, OPINIE_DO_KSIAZEK,
    WYDAWNICTWO, WERSJA_WYDANIA, WERSJE_WYDANIA_KSIAZEK, GATUNKI_ULUBIONE,
]
PEOPLE = [ADRES_POCZTY, OSOBY, HELP_TABLE]
