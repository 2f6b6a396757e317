"""Gold labels and builders on small literal tables, and totals that must agree."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from comptoir.operators import totals
from comptoir.operators.totals import roll_up
from comptoir.plans import gold
from comptoir.plans.layers import ROLLUPS, Gold
from comptoir.sources.stores import written
from conftest import final_plan

SALES = (
    "vente_id long, date_vente date, client_id long, produit_id long, canal_id int, quantite int,"
    " montant decimal(18,2), nom_canal string, categorie_produit string"
)
GOODS = "produit_id long, nom string, categorie string, marque string, prix decimal(18,2)"


def sale(i, day, client=1, product=1, quantity=1, amount="1.00", channel=1):
    return (i, dt.date.fromisoformat(day), client, product, channel, quantity, Decimal(amount), f"C{channel}", "Cat")


@pytest.mark.parametrize("stock, days, label", [
    (0, 9999.0, "🔴 RUPTURE"), (0, 0.0, "🔴 RUPTURE"), (5, 7.0, "🟠 CRITIQUE"), (5, 8.0, "🟡 FAIBLE"),
    (5, 30.0, "🟡 FAIBLE"), (5, 31.0, "🟢 NORMAL"), (5, 364.0, "🟢 NORMAL"), (5, 365.0, "🔵 SUR-STOCK"),
    (5, 9999.0, "🔵 SUR-STOCK")])
def test_alert_levels(spark, stock, days, label):
    assert spark.range(1).select(gold.alert_level(F.lit(stock), F.lit(days))).first()[0] == label


@pytest.mark.parametrize("score, recency, label", [
    (12, 4, "💎 Champion"), (11, 3, "💎 Champion"), (10, 3, "⭐ Fidèle"), (9, 4, "⭐ Fidèle"),
    (10, 2, "😴 A Risque"), (9, 1, "😴 A Risque"), (8, 4, "📈 Potentiel"), (7, 1, "📈 Potentiel"),
    (6, 3, "🆕 Nouveau"), (5, 4, "🆕 Nouveau"), (6, 2, "💤 Perdu"), (3, 1, "💤 Perdu")])
def test_rfm_segments(spark, score, recency, label):
    assert spark.range(1).select(gold.rfm_segment(F.lit(score), F.lit(recency))).first()[0] == label


def test_stock_alert_without_sales_and_with_one_day(spark):
    goods = spark.createDataFrame([(1, "a", "c", "m", Decimal("2.50")), (2, "b", "c", "m", Decimal("1.00"))], GOODS)
    stocks = spark.createDataFrame([(1, "x", 3), (1, "y", 4), (2, "x", 6), (3, "x", 1)],
                                   "produit_id long, depot string, quantite_disponible int")
    sales = spark.createDataFrame([sale(1, "2024-01-01", quantity=2)], SALES)
    found = {r.produit_id: r for r in gold.stock_alert(stocks, sales, goods).collect()}
    assert (found[1].stock_total, found[1].ventes_par_jour, found[1].jours_de_stock) == (7, 2.0, 4.0)
    assert (found[1].alerte, found[1].valeur_stock) == ("🟠 CRITIQUE", 17.5)
    assert (found[2].total_vendu, found[2].jours_de_stock, found[2].alerte) == (0, 9999.0, "🔵 SUR-STOCK")
    assert found[3].nom is None and found[3].valeur_stock is None


def test_growth_needs_a_positive_month_before(spark):
    sales = spark.createDataFrame([
        sale(1, "2024-01-05", amount="0.00"), sale(2, "2024-02-05", amount="10.00"),
        sale(3, "2024-04-05", amount="15.00"), sale(4, "2024-04-06", amount="1.00", channel=2)], SALES)
    found = {(r.canal_id, r.mois): (r.ca_mois_precedent, r.croissance_pct)
             for r in gold.canal_performance(sales).collect()}
    assert found == {(1, 1): (None, None), (1, 2): (0.0, None), (1, 4): (10.0, 50.0), (2, 4): (None, None)}


def test_moving_average_over_rows_or_calendar_days(spark):
    days = [f"2024-01-{d:02d}" for d in (1, 2, 3, 4, 5, 6, 7, 20)]
    sales = spark.createDataFrame([sale(i, d, amount=f"{i + 1}.00") for i, d in enumerate(days)], SALES)
    last = lambda df: df.where("date_vente = '2024-01-20'").first()
    rows = last(gold.daily_trend(sales))
    assert (rows.moyenne_mobile_7j, rows.moyenne_mobile_30j, rows.ca_cumule) == (5.0, 4.5, 36.0)
    calendar = last(gold.daily_trend(sales, calendar=True))
    assert (calendar.moyenne_mobile_7j, calendar.moyenne_mobile_30j) == (8.0, 4.5)


def test_top_products_share_a_rank(spark):
    goods = spark.createDataFrame([(1, "a", "c", "m", Decimal("2.50"))], GOODS)
    sales = spark.createDataFrame(
        [sale(i, "2024-01-01", product=p, quantity=q) for i, (p, q) in enumerate([(1, 5), (2, 5), (3, 9), (4, 1)])],
        SALES)
    found = sorted((r.rang, r.produit_id, r.nom) for r in gold.top_products(sales, goods, k=3).collect())
    assert found == [(1, 3, None), (2, 1, "a"), (2, 2, None)]


def test_return_rate_can_exceed_one_hundred(spark):
    goods = spark.createDataFrame([(1, "a", "c", "m", Decimal("2.50"))], GOODS)
    sales = spark.createDataFrame([sale(1, "2024-01-01"), sale(2, "2024-01-01", product=2)], SALES)
    returns = spark.createDataFrame(
        [(1, 1, Decimal("3.00")), (2, 1, Decimal("0.50")), (3, 7, Decimal("1.00"))],
        "retour_id long, produit_id long, montant_retour decimal(18,2)")
    found = {r.produit_id: (r.nb_retours, r.montant_retours, r.taux_retour_pct)
             for r in gold.return_rate(sales, returns, goods).collect()}
    assert found == {1: (2, 3.5, 200.0), 2: (0, 0.0, 0.0)}


def test_clients_missing_from_the_dimension_stay(spark):
    clients = spark.createDataFrame([(1, "N", "P", "Rabat", "PRO", "R")],
                                    "client_id long, nom string, prenom string, ville string, segment string, region string")
    sales = spark.createDataFrame([sale(1, "2024-01-01"), sale(2, "2024-01-01", client=2)], SALES)
    found = {(r.region, r.ville, r.nb_ventes) for r in gold.sales_by_region(sales, clients).collect()}
    assert found == {("R", "Rabat", 1), (None, None, 1)}
    assert gold.sales_by_segment(sales, clients).agg(F.sum("nb_clients_actifs")).first()[0] == 2


def test_totals_agree(house):
    ventes = house.silver.ventes
    count, amount = ventes.agg(F.count("vente_id"), F.sum("montant")).first()
    for name in ("ca_daily", "ca_weekly", "ca_monthly", "ca_by_canal", "sales_by_region",
                 "sales_by_category", "sales_by_segment"):
        found = house.gold[name].agg(F.sum("nb_ventes"), F.sum(F.col("ca_total").cast("decimal(28,2)"))).first()
        assert tuple(found) == (count, amount), name
    basket = house.gold.customer_basket.agg(F.sum("nb_achats"), F.sum(F.col("ca_total_client").cast("decimal(28,2)")))
    assert tuple(basket.first()) == (count, amount)
    assert house.gold.daily_trend.agg(F.max("ca_cumule")).first()[0] == float(amount)
    assert house.gold.ca_by_canal.agg(F.sum("part_ca_pct")).first()[0] == pytest.approx(100, abs=0.05)


def test_silver_keys_are_unique(house):
    keys = {"clients": ["client_id"], "produits": ["produit_id"], "ventes": ["vente_id"],
            "stocks": ["produit_id", "depot"], "retours": ["retour_id"], "canaux": ["canal_id"]}
    for name, key in keys.items():
        df = house.silver[name]
        assert df.count() == df.select(*key).distinct().count(), name


def test_builders_give_the_same_from_rollups(house):
    ventes = house.silver.ventes
    rolled = Gold(house.silver, **{name: written(build(ventes), name) for name, build in ROLLUPS.items()})
    for name in ("ca_daily", "ca_weekly", "ca_monthly", "ca_by_canal", "sales_by_category", "sales_by_region",
                 "customer_basket", "sales_by_segment", "top_products", "return_rate", "stock_alert",
                 "canal_performance", "daily_trend"):
        fresh = sorted(map(repr, Gold(house.silver)[name].collect()))
        assert sorted(map(repr, rolled[name].collect())) == fresh, name


def test_distinct_clients_roll_up(spark):
    """Ids over many buckets, negative ones and none; the same client on several days and channels."""
    ids = [1, 2, 32_767, 32_768, 32_769, 65_536, 10**12, -1, -32_768, None]
    rows = [sale(n, f"2024-0{1 + n % 3}-{1 + n % 9:02}", client=ids[n * 7 % len(ids)], channel=n % 2) for n in range(400)]
    sales = spark.createDataFrame(rows, SALES)
    by_day = written(totals.roll_up_clients(sales, "date_vente", "canal_id", "nom_canal"), "by-day-clients")
    known = lambda keep: len({r[2] for r in rows if keep(r) and r[2] is not None})
    for table in (sales, by_day):
        months = {(r.mois, r.canal_id): r.nb_clients_uniques for r in gold.canal_performance(table).collect()}
        assert months == {(m, c): known(lambda r: (r[1].month, r[4]) == (m, c)) for m, c in months}
        days = {r.date_vente: (r.nb_clients_actifs, r.nb_ventes) for r in gold.daily_trend(table).collect()}
        assert days == {d: (known(lambda r: r[1] == d), sum(r[1] == d for r in rows)) for d in days}
    plan = final_plan(gold.canal_performance(by_day))
    assert "Expand" not in plan and "client_id" not in plan


def test_approximate_quartiles_stay_close(house):
    per_client = roll_up(house.silver.ventes, "client_id", days=True)
    clients = house.silver.clients
    exact = gold.client_rfm(per_client, clients).count()
    assert gold.client_rfm(per_client, clients, exact=False).count() == exact
