"""Reports over the gold tables; each takes the gold ``Tables`` and is lazy.

Where a report keeps the first k rows, further columns settle ties, so the
same rows come out on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from comptoir.functions.numbers import mean, percent, sum_money
from comptoir.plans.gold import A_RISQUE, CHAMPION, CRITIQUE, PERDU, RUPTURE
from comptoir.plans.layers import Tables

REVENUE = ["ca_total", "nb_ventes", "panier_moyen", "total_quantite"]


def _total(column: str, name: str | None = None):
    return sum_money(F.col(column)).cast("double").alias(name or column)


def _as_text(number, name: str):
    """Amounts as plain text with two decimals, never in scientific notation."""
    return number.cast("decimal(38,2)").cast("string").alias(name)


# -- revenue -------------------------------------------------------------------

def daily_last30(gold: Tables) -> DataFrame:
    return gold.ca_daily.select("date_vente", *REVENUE).orderBy(F.desc("date_vente")).limit(30)


def monthly(gold: Tables) -> DataFrame:
    return gold.ca_monthly.orderBy("annee", "mois").select("mois_label", *REVENUE)


def monthly_latest_first(gold: Tables) -> DataFrame:
    months = gold.ca_monthly.withColumnRenamed("ca_total", "ca_mensuel")
    latest = months.orderBy(F.desc("annee"), F.desc("mois"))
    return latest.select("annee", "mois", "mois_label", "ca_mensuel", "nb_ventes")


def weekly(gold: Tables) -> DataFrame:
    return gold.ca_weekly.select("annee", "semaine", *REVENUE[:3]).orderBy("annee", "semaine")


def global_totals(gold: Tables) -> DataFrame:
    """The basket is the mean of the monthly means, not weighted."""
    return gold.ca_monthly.agg(
        _total("ca_total", "ca_global"),
        F.sum("nb_ventes").alias("total_ventes"),
        mean(F.col("panier_moyen")).alias("panier_moyen_global"),
    )


# -- channels -------------------------------------------------------------------

def by_channel(gold: Tables) -> DataFrame:
    return gold.ca_by_canal.orderBy(F.desc("ca_total"), F.asc_nulls_last("nom_canal")).select("nom_canal", *REVENUE, "part_ca_pct")


def channel_growth(gold: Tables) -> DataFrame:
    ordered = gold.canal_performance.orderBy("nom_canal", "annee", "mois")
    return ordered.select(
        "nom_canal", "mois_label", "ca_total", "nb_ventes", "nb_clients_uniques", "croissance_pct")


# -- products -------------------------------------------------------------------

def top10_products(gold: Tables) -> DataFrame:
    return gold.top_products.where("rang <= 10").orderBy("rang", "produit_id").select(
        "rang", "nom", "categorie", "marque", "prix", "total_quantite_vendue", "ca_total", "nb_transactions")


def category_by_month(gold: Tables) -> DataFrame:
    columns = ["categorie_produit", "mois_label", "ca_total", "nb_ventes", "total_quantite"]
    return gold.sales_by_category.select(*columns).orderBy(*columns[:2])


# -- places ---------------------------------------------------------------------

def by_region(gold: Tables) -> DataFrame:
    return (
        gold.sales_by_region.groupBy("region")
        .agg(_total("ca_total", "ca_region"), F.sum("nb_ventes").alias("nb_ventes"),
             mean(F.col("panier_moyen")).alias("panier_moyen"))
        .orderBy(F.desc("ca_region"), F.asc_nulls_last("region"))
    )


def top10_cities(gold: Tables) -> DataFrame:
    cities = gold.sales_by_region.select("ville", "region", "ca_total", "nb_ventes", "panier_moyen")
    return cities.orderBy(
        F.desc("ca_total"), F.asc_nulls_last("region"), F.asc_nulls_last("ville")).limit(10)


# -- clients --------------------------------------------------------------------

def top20_clients(gold: Tables) -> DataFrame:
    best = gold.customer_basket.orderBy(F.desc("ca_total_client"), F.asc_nulls_last("client_id")).limit(20)
    return best.select(
        "nom", "prenom", "ville", "segment", "nb_achats", "ca_total_client", "panier_moyen", "total_articles")


def segment_share(gold: Tables) -> DataFrame:
    """The window sees one row per segment."""
    whole = sum_money(F.col("ca_total")).over(Window.partitionBy())
    shares = gold.sales_by_segment.select(
        "segment", "ca_total", "nb_ventes", "nb_clients_actifs", "panier_moyen",
        percent(F.col("ca_total"), whole).alias("part_pct"))
    return shares.orderBy(F.desc("ca_total"), F.asc_nulls_last("segment"))


def rfm_summary(gold: Tables) -> DataFrame:
    """``panier_moyen`` here is the mean spend of a client."""
    return (
        gold.client_rfm.groupBy("rfm_segment")
        .agg(
            F.count("*").alias("nb_clients"),
            mean(F.col("montant_total")).alias("panier_moyen"),
            mean(F.col("recence_jours"), 0).alias("recence_moyenne_jours"),
            mean(F.col("frequence"), 1).alias("frequence_moyenne"),
            _total("montant_total", "ca_segment"),
        )
        .orderBy(F.desc("ca_segment"), F.asc_nulls_last("rfm_segment"))
    )


def champions(gold: Tables) -> DataFrame:
    best = gold.client_rfm.where(F.col("rfm_segment") == CHAMPION)
    return best.orderBy(F.desc("montant_total"), F.asc_nulls_last("client_id")).select(
        "nom", "prenom", "ville", "region", "recence_jours", "frequence",
        "montant_total", "rfm_score", "rfm_segment")


def win_back(gold: Tables) -> DataFrame:
    leaving = gold.client_rfm.where(F.col("rfm_segment").isin(A_RISQUE, PERDU))
    return leaving.orderBy(F.desc("montant_total"), F.asc_nulls_last("client_id")).select(
        "nom", "prenom", "ville", "recence_jours", "frequence", "montant_total", "rfm_segment")


# -- returns --------------------------------------------------------------------

def _worst_rates(rates: DataFrame, k: int) -> DataFrame:
    return rates.orderBy(F.desc("taux_retour_pct"), "produit_id").limit(k)


def return_top10(gold: Tables) -> DataFrame:
    return _worst_rates(gold.return_rate.where("nb_retours > 0"), 10).select(
        "nom", "categorie", "marque", "nb_ventes", "nb_retours", "taux_retour_pct", "montant_retours")


def return_top20(gold: Tables) -> DataFrame:
    return _worst_rates(gold.return_rate, 20).select(
        "nom", "categorie", "nb_ventes", "nb_retours", "taux_retour_pct")


def return_by_category(gold: Tables) -> DataFrame:
    return (
        gold.return_rate.groupBy("categorie")
        .agg(
            F.sum("nb_ventes").alias("total_ventes"),
            F.sum("nb_retours").alias("total_retours"),
            percent(F.sum("nb_retours"), F.sum("nb_ventes")).alias("taux_retour_pct"),
            _total("montant_retours", "montant_total_retours"),
        )
        .orderBy(F.desc("taux_retour_pct"), F.asc_nulls_last("categorie"))
    )


# -- stock ----------------------------------------------------------------------

def _short_of_stock(gold: Tables) -> DataFrame:
    return gold.stock_alert.where(F.col("alerte").isin(RUPTURE, CRITIQUE)).orderBy("jours_de_stock", F.asc_nulls_last("produit_id"))


def stock_critical(gold: Tables) -> DataFrame:
    return _short_of_stock(gold).select(
        "nom", "categorie", "marque", "stock_total", "ventes_par_jour",
        "jours_de_stock", "alerte", "valeur_stock")


def stock_summary(gold: Tables) -> DataFrame:
    return (
        gold.stock_alert.groupBy("alerte")
        .agg(F.count("*").alias("nb_produits"), F.sum("stock_total").alias("stock_total"),
             _total("valeur_stock", "valeur_totale"))
        .orderBy("alerte")
    )


# -- trend and executive view -----------------------------------------------------

def trend_last90(gold: Tables) -> DataFrame:
    return gold.daily_trend.orderBy(F.desc("date_vente")).limit(90)


def affinity_top20(gold: Tables) -> DataFrame:
    return gold.product_affinity.orderBy(
        F.desc("nb_clients_communs"), "produit_a", "produit_b",
        F.asc_nulls_last("categorie_a"), F.asc_nulls_last("categorie_b")).limit(20)


def executive_row(gold: Tables) -> DataFrame:
    return gold.ca_monthly.agg(
        _total("ca_total", "ca_global"),
        F.sum("nb_ventes").alias("total_commandes"),
        mean(F.col("panier_moyen")).alias("panier_moyen_global"),
        F.max("ca_total").alias("meilleur_mois_ca"),
        F.min("ca_total").alias("moins_bon_mois_ca"),
    )


def executive_lines(gold: Tables) -> DataFrame:
    """One line per indicator, the value as text."""
    months = gold.ca_monthly.agg(
        _as_text(sum_money(F.col("ca_total")), "ca"), F.sum("nb_ventes").cast("string").alias("nb"))
    baskets = gold.customer_basket.agg(_as_text(mean(F.col("panier_moyen")), "valeur"))
    rates = gold.return_rate.agg(_as_text(mean(F.col("taux_retour_pct")), "valeur"))

    def line(name: str, value):
        return F.struct(F.lit(name).alias("indicateur"), value.alias("valeur"))

    both = F.array(line("CA Total", F.col("ca")), line("Nb Ventes", F.col("nb")))
    return (
        months.select(F.inline(both))
        .unionAll(baskets.select(F.lit("Panier Moyen"), "valeur"))
        .unionAll(rates.select(F.lit("Taux Retour %"), "valeur"))
    )


REPORTS = {
    "q_daily_last30": daily_last30,
    "q_monthly": monthly,
    "q_monthly_desc": monthly_latest_first,
    "q_weekly": weekly,
    "q_global_totals": global_totals,
    "q_by_channel": by_channel,
    "q_channel_growth": channel_growth,
    "q_top10_products": top10_products,
    "q_category_month": category_by_month,
    "q_region": by_region,
    "q_city_top10": top10_cities,
    "q_client_top20": top20_clients,
    "q_segment_share": segment_share,
    "q_rfm_summary": rfm_summary,
    "q_champions": champions,
    "q_winback": win_back,
    "q_return_top10": return_top10,
    "q_return_top20": return_top20,
    "q_return_category": return_by_category,
    "q_stock_critical": stock_critical,
    "q_stock_summary": stock_summary,
    "q_trend_last90": trend_last90,
    "q_affinity_top20": affinity_top20,
    "q_exec_row": executive_row,
    "q_exec_long": executive_lines,
}
