"""Cleaning rules on small literal tables."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from comptoir.functions.calendar import to_day, week_columns
from comptoir.functions.geography import REGION_CITIES, region_of
from comptoir.functions.numbers import half_up, percent, ratio
from comptoir.functions.text import or_default
from comptoir.operators.dedup import one_per_key
from comptoir.operators.marks import key_marks, may_hold
from comptoir.plans import silver
from comptoir.plans.layers import Silver
from comptoir.plans.rules import row_counts
from comptoir.sources.schemas import SCHEMAS
from conftest import final_plan


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, name, *values):
    return spark.createDataFrame(list(values), SCHEMAS[name])


@pytest.mark.parametrize("given, kept", [(None, "x"), ("", "x"), ("   ", "x"), (" a ", " a "), ("b", "b")])
def test_blank_default(spark, given, kept):
    df = spark.createDataFrame([(given,)], "c string").select(or_default(F.col("c"), "x"))
    assert df.first()[0] == kept


def test_dedup_keeps_the_smallest_row_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 5), (2, "a", 1), (None, "z", 1), (None, "y", 2), (3, None, 4)],
        "k int, s string, n int")
    assert rows(one_per_key(df, "k")) == sorted([(1, "a", 3), (2, "a", 1), (None, "y", 2), (3, None, 4)], key=repr)
    assert one_per_key(df, "k").columns == df.columns


def test_dedup_prefers_the_complete_copy(spark):
    """A gap in a required column weighs more than any order of the others."""
    df = spark.createDataFrame(
        [(1, "a", None, 9), (1, "z", 5, None), (2, None, None, 1), (2, None, 7, 8), (2, "b", None, 3)], "k int, s string, n int, m int")
    kept = one_per_key(df, "k", required=("s", "n"))
    assert rows(kept) == sorted([(1, "z", 5, None), (2, "b", None, 3)], key=repr)
    # The comparison follows the declared order, not the frame's.
    ties = spark.createDataFrame([(1, 1, 2), (1, 2, 1)], "k int, x int, y int")
    assert rows(one_per_key(ties, "k", order=("y", "x"))) == [(1, 2, 1)]


def test_a_complete_sale_survives_a_gappy_copy(spark):
    day = dt.date(2024, 1, 31)
    bronze = table(spark, "ventes", *((i, d, c, 8, 1, 2, Decimal(3)) for i, d, c in ((1, None, 7), (1, day, 7), (2, day, None), (2, None, None))))
    assert [r.vente_id for r in silver.sales_without_lookups(bronze).collect()] == [1]


def test_clients(spark):
    day = dt.date(2024, 1, 31)
    bronze = table(
        spark, "clients",
        (1, " dupont ", "JEAN paul", "casablanca", "premium", "2024-01-31"),
        (1, " dupont ", "JEAN paul", "casablanca", "premium", "2024-01-31"),
        (2, None, "", "  ", None, "not a date"),
        (3, "x", "y", " el JADIDA ", "pro", "2024-01-31"),
        (4, "x", "y", "Paris", "pro", None),
    )
    assert rows(silver.clients(bronze)) == [
        (1, "DUPONT", "Jean Paul", "Casablanca", "PREMIUM", day, "Casablanca-Settat"),
        (2, "INCONNU", "Inconnu", "Inconnu", "STANDARD", None, "Autres"),
        (3, "X", "Y", "El Jadida", "PRO", day, "Casablanca-Settat"),
        (4, "X", "Y", "Paris", "PRO", None, "Autres"),
    ]


def test_every_city_has_its_region(spark):
    cities = [(c, region) for region, group in REGION_CITIES.items() for c in group]
    assert len(cities) == 28
    df = spark.createDataFrame(cities, "c string, r string")
    assert df.where(region_of(F.col("c")) != F.col("r")).count() == 0


def test_products_take_the_median_of_all_prices(spark):
    money = Decimal
    bronze = table(
        spark, "produits",
        (1, " a ", "sport", money("10.00"), "nike"),
        (1, " a ", "sport", money("10.00"), "nike"),
        (2, None, None, money("-5.00"), ""),
        (3, "c", "  ", None, None),
        (4, "d", "maison deco", money("30.00"), "x"),
        (5, "e", "maison", money("0.00"), "x"),
    )
    # -5, 0, 10, 10, 30: repeated and invalid prices count, nulls do not.
    assert rows(silver.produits(bronze)) == [
        (1, "a", "Sport", money("10.00"), "Nike"),
        (2, "Produit Inconnu", "Non Classé", money("10.00"), "Inconnue"),
        (3, "c", "Non Classé", money("10.00"), "Inconnue"),
        (4, "d", "Maison Deco", money("30.00"), "X"),
        (5, "e", "Maison", money("10.00"), "X"),
    ]


def test_sales_are_repaired_filtered_and_enriched(spark):
    day = dt.date(2024, 5, 1)
    sales = table(
        spark, "ventes",
        (1, day, 7, 100, 1, 2, Decimal("9.50")),
        (1, day, 7, 100, 1, 2, Decimal("9.50")),
        (2, day, 7, 101, 9, 0, Decimal("-1.00")),
        (3, day, 7, 999, None, None, None),
        (4, None, 7, 100, 1, 1, Decimal("1.00")),
        (5, day, None, 100, 1, 1, Decimal("1.00")),
        (6, day, 7, None, 1, 1, Decimal("1.00")),
    )
    # Lookup keys are repeated; sales must not multiply.
    channels = table(spark, "canaux", (1, " web "), (1, " web "))
    products = table(
        spark, "produits",
        (100, "p", " haute COUTURE ", Decimal("5.00"), "m"), (100, "p", " haute COUTURE ", Decimal("5.00"), "m"),
        (101, "q", "  ", Decimal("-1.00"), "m"))
    found = silver.ventes(sales, channels, products).select(
        "vente_id", "quantite", "montant", "canal_id", "nom_canal", "categorie_produit", "prix_unitaire")
    assert rows(found) == [
        (1, 2, Decimal("9.50"), 1, "WEB", "Haute Couture", Decimal("5.00")),
        (2, 1, Decimal("0.00"), 9, "INCONNU", "", Decimal("-1.00")),
        (3, 1, Decimal("0.00"), None, "INCONNU", "Non classé", None),
    ]


def test_stocks(spark):
    bronze = table(spark, "stocks", (1, "tanger", 5), (1, "tanger", 5), (1, None, -2), (2, " ", None))
    assert rows(silver.stocks(bronze)) == [(1, "Dépôt Inconnu", 0), (1, "Tanger", 5), (2, "Dépôt Inconnu", 0)]


def test_returns_carry_the_raw_sale(spark):
    day = dt.date(2024, 5, 1)
    sales = table(
        spark, "ventes", (1, day, 7, 100, 2, 1, Decimal("-4.00")), (1, day, 7, 100, 2, 1, Decimal("-4.00")))
    bronze = table(
        spark, "retours",
        (10, 1, 55, "mauvaise_taille", day), (10, 1, 55, "mauvaise_taille", day), (11, 99, 55, "", day), (12, None, 5, None, None))
    assert rows(silver.retours(bronze, sales)) == [
        (10, 1, 55, "Mauvaise_taille", day, Decimal("-4.00"), 2, 7),
        (11, 99, 55, "Non Spécifié", day, Decimal("0.00"), None, None),
        (12, None, 5, "Non Spécifié", None, Decimal("0.00"), None, None),
    ]


def test_channels(spark):
    bronze = table(spark, "canaux", (1, " web "), (2, None), (3, "  "), (3, "  "))
    assert rows(silver.canaux(bronze)) == [(1, "WEB"), (2, "INCONNU"), (3, "INCONNU")]


def test_iso_week_keeps_the_calendar_year(spark):
    df = spark.sql("SELECT date'2024-12-30' d UNION ALL SELECT date'2023-01-01'")
    assert rows(df.select(*week_columns(F.col("d")))) == [(2023, 52), (2024, 1)]


def test_text_that_is_no_date(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("x",), (None,)], "c string")
    assert rows(df.select(to_day(F.col("c")))) == sorted([(None,), (None,), (None,), (dt.date(2024, 2, 29),)], key=repr)


def test_rounding_is_half_up_and_division_by_zero_is_null(spark):
    df = spark.range(1).select(
        half_up(F.lit(1.005)), half_up(F.lit(-2.675)), half_up(F.lit(2.5), 0),
        ratio(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(3)))
    assert tuple(df.first()) == (1.01, -2.68, 3.0, None, 33.33)


def test_few_sales_that_were_not_returned_are_shuffled(spark, conf):
    """With broadcasts off: the marks are tested in the scan's stage, and let few others pass."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sales = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("vente_id"), F.lit(dt.date(2024, 1, 1)).alias("date_vente"), F.lit(1).cast("long").alias("client_id"),
        F.lit(1).cast("long").alias("produit_id"), F.lit(1).alias("canal_id"), F.lit(1).alias("quantite"),
        F.col("id").cast("decimal(18,2)").alias("montant"))
    returns = spark.createDataFrame([(i, i * 97, 1, "x", None) for i in range(2000)], SCHEMAS["retours"])
    wanted = returns.select("vente_id").distinct()
    near = sales.where(silver.may_hold(silver.key_marks(wanted), F.col("vente_id")))
    assert 2000 <= near.count() < 200_000 / 10
    plan = final_plan(silver.returned(sales, wanted, many=True))
    assert "SortMergeJoin" in plan and re.search(r"Exchange hashpartitioning[^\n]*\n(?:[^\n]*Project[^\n]*\n)?[^\n]*Filter \(getbit", plan)
    for many in (False, True):
        got = {r.retour_id: r.montant_retour for r in silver.retours(returns, sales, many=many).collect()}
        assert got == {i: Decimal(i * 97) for i in range(2000)}


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_marks_forget_no_key(spark, n):
    keys = spark.range(n).select((F.col("id") * 7 - 3).alias("k"))
    marked = spark.range(-10, 8000).select(F.col("id").alias("k")).where(may_hold(key_marks(keys, most=1 << 12), F.col("k")))
    assert {7 * i - 3 for i in range(n)} <= {r.k for r in marked.collect()}
    assert n or marked.count() == 0


def test_sales_are_counted_by_the_columns_that_decide(spark):
    """Copies with gaps and with texts that are no dates; the count has the rows of silver_ventes and sorts no amounts."""
    head = "vente_id long, date_vente string, client_id long, produit_id long, canal_id int, quantite int, montant decimal(18,2)"
    rows = [(i % 40 if i % 9 else None, (None, "2024-01-02", "no date", "2024-03-05")[i * 7 % 4], None if i % 5 == 0 else i % 3,
             None if i % 11 == 0 else i % 4, i % 6, -i if i % 4 else None, None) for i in range(200)]
    bronze = spark.createDataFrame(rows, head)
    goods = spark.createDataFrame([], "produit_id long, nom string, categorie string, prix decimal(18,2), marque string")
    whole = silver.ventes(bronze, spark.createDataFrame([], "canal_id int, nom string"), goods)
    counted = silver.counted_sales(bronze)
    key = ["vente_id", "date_vente", "client_id", "produit_id"]
    assert sorted(map(str, counted.select(key).collect())) == sorted(map(str, whole.select(key).collect()))
    assert 0 < counted.count() < bronze.select("vente_id").distinct().count()
    aggregates = [line for line in counted._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line]
    assert aggregates and "montant" not in "".join(aggregates)


def test_row_counts_of_sales_build_no_whole_sales(house, monkeypatch):
    expected = house.silver.ventes.count()
    monkeypatch.setattr(silver, "ventes", None)
    counted = {r.table: r.silver for r in row_counts(house.bronze, Silver(house.bronze)).collect()}
    assert counted["ventes"] == expected
