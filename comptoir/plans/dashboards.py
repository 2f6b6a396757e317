"""The data set behind each dashboard chart and tile.

A chart names a gold table, a dimension, metrics and a filter; ``series`` turns
that into one grouped query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from comptoir.functions.numbers import mean, sum_money
from comptoir.plans import serving
from comptoir.plans.layers import Tables


def series(table: DataFrame, *dimensions: str, **metrics: Column) -> DataFrame:
    return table.groupBy(*dimensions).agg(*(m.alias(name) for name, m in metrics.items()))


def total(column: str) -> Column:
    return sum_money(F.col(column)).cast("double")


def monthly_ca(gold: Tables) -> DataFrame:
    return series(gold.ca_monthly, "mois_label", ca_total=total("ca_total")).orderBy("mois_label")


def channel_ca(gold: Tables) -> DataFrame:
    return series(gold.ca_by_canal, "nom_canal", ca_total=total("ca_total"))


def top_products(gold: Tables) -> DataFrame:
    bars = series(gold.top_products, "nom", total_quantite_vendue=F.sum("total_quantite_vendue"))
    return bars.orderBy(F.desc("total_quantite_vendue"), "nom")


def region_ca(gold: Tables) -> DataFrame:
    return series(gold.sales_by_region, "region", ca_total=total("ca_total"))


def return_by_name(gold: Tables) -> DataFrame:
    returned = gold.return_rate.where("nb_retours > 0")
    bars = series(returned, "nom", taux_retour_pct=F.max("taux_retour_pct"))
    return bars.orderBy(F.desc("taux_retour_pct"), F.asc_nulls_last("nom")).limit(10)


def rfm_pie(gold: Tables) -> DataFrame:
    return series(gold.client_rfm, "rfm_segment", nb_clients=F.count("client_id"))


def trend_series(gold: Tables) -> DataFrame:
    lines = gold.daily_trend.select("date_vente", "ca_jour", "moyenne_mobile_7j", "moyenne_mobile_30j")
    return lines.orderBy("date_vente")


def stock_table(gold: Tables) -> DataFrame:
    return serving.stock_critical(gold).select("nom", "categorie", "stock_total", "jours_de_stock", "alerte")


def segment_bars(gold: Tables) -> DataFrame:
    return series(gold.sales_by_segment, "segment", ca_total=total("ca_total"),
                  nb_clients_actifs=F.sum("nb_clients_actifs"))


def kpi_tiles(gold: Tables) -> DataFrame:
    """Revenue from the months, orders and mean basket from the days."""
    revenue = gold.ca_monthly.agg(total("ca_total").alias("v")).scalar()
    days = gold.ca_daily.agg(
        F.sum("nb_ventes").alias("total_commandes"), mean(F.col("panier_moyen")).alias("panier_moyen"))
    return days.select(revenue.alias("ca_global"), "total_commandes", "panier_moyen")


def region_city(gold: Tables) -> DataFrame:
    return series(gold.customer_basket, "region", "ville", ca_total=total("ca_total_client"))


def basket_by_segment(gold: Tables) -> DataFrame:
    return series(gold.customer_basket, "segment", panier_moyen=mean(F.col("panier_moyen")))


def category_line(gold: Tables) -> DataFrame:
    lines = series(gold.sales_by_category, "mois_label", "categorie_produit", ca_total=total("ca_total"))
    return lines.orderBy("mois_label", "categorie_produit")


CHARTS = {
    "d_monthly_ca": monthly_ca,
    "d_channel_ca": channel_ca,
    "d_top_products": top_products,
    "d_region_ca": region_ca,
    "d_return_by_name": return_by_name,
    "d_rfm_pie": rfm_pie,
    "d_trend_series": trend_series,
    "d_stock_table": stock_table,
    "d_segment": segment_bars,
    "d_kpi_tiles": kpi_tiles,
    "d_region_city": region_city,
    "d_basket_segment": basket_by_segment,
    "d_category_line": category_line,
}
