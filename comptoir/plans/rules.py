"""Single cleaning rules and operators, each over a whole bronze or silver table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from comptoir.functions import calendar, numbers, text
from comptoir.functions.geography import region_of
from comptoir.plans import silver
from comptoir.plans.layers import BRONZE, SILVER, Silver, Tables
from comptoir.plans.watch import REPORT, Watch


def blank_defaults(bronze: Tables) -> DataFrame:
    defaults = {"ville": "Inconnu", "segment": "Standard", "nom": "Inconnu", "prenom": "Inconnu"}
    return bronze.clients.select(
        "client_id", *(text.or_default(F.col(c), d).alias(c) for c, d in defaults.items()))


def numeric_defaults(bronze: Tables) -> DataFrame:
    return bronze.ventes.select(
        "vente_id",
        numbers.positive_or(F.col("quantite"), F.lit(1)).alias("quantite"),
        numbers.positive_or(F.col("montant"), F.lit(0)).alias("montant"),
    )


def price_defaults(bronze: Tables) -> DataFrame:
    median = silver.median_price(bronze.produits)
    return bronze.produits.select("produit_id", numbers.positive_or(F.col("prix"), median).alias("prix"))


def normalised_text(bronze: Tables) -> DataFrame:
    return bronze.clients.select(
        "client_id", text.title(F.col("ville")).alias("ville"),
        text.capitals(F.col("segment")).alias("segment"), F.trim("prenom").alias("prenom"))


def dates_from_text(bronze: Tables) -> DataFrame:
    return bronze.clients.select(
        "client_id", calendar.to_day(F.col("date_inscription")).alias("date_inscription"),
        calendar.to_day(F.col("ville")).alias("not_a_date"))


def date_parts(bronze: Tables) -> DataFrame:
    day = F.col("date_vente")
    days = bronze.ventes.where(day.isNotNull()).groupBy(day).agg(F.count("*").alias("n"))
    annee, semaine = calendar.week_columns(day)
    _, mois, label = calendar.month_columns(calendar.month_start(day))
    return days.select(day, annee, semaine, mois, F.date_format(day, "yyyy-MM").alias("mois_label"), "n")


def rounding(bronze: Tables) -> DataFrame:
    sums = bronze.ventes.groupBy("produit_id").agg(
        F.sum("montant").alias("m"), F.sum("quantite").alias("q"), F.count("*").alias("n"))
    return sums.select(
        "produit_id", numbers.ratio(F.col("m"), F.col("q")).alias("prix_moyen"),
        numbers.ratio(F.col("m"), F.col("q"), 0).alias("prix_entier"),
        numbers.percent(F.col("q"), F.col("n")).alias("quantite_pct"))


def regions(bronze: Tables) -> DataFrame:
    ville = text.title(F.col("ville"))
    return bronze.clients.select("client_id", ville.alias("ville"), region_of(ville).alias("region"))


def deduplicated_sales(bronze: Tables) -> DataFrame:
    return silver.survivors(bronze.ventes, "ventes", "vente_id")


def valid_sales(bronze: Tables) -> DataFrame:
    return silver.sales_without_lookups(bronze.ventes)


def sales_with_channel(bronze: Tables) -> DataFrame:
    return silver.with_channel(bronze.ventes.select("vente_id", "canal_id"), bronze.canaux)


def sales_with_product(bronze: Tables) -> DataFrame:
    return silver.with_product(bronze.ventes.select("vente_id", "produit_id"), bronze.produits)


def returns_with_sale(bronze: Tables) -> DataFrame:
    return silver.with_sale(bronze.retours.select("retour_id", "vente_id"), bronze.ventes)


def row_counts(bronze: Tables, silver_tables: Tables) -> DataFrame:
    """Rows before and after cleaning, per table."""
    def counted(name: str) -> DataFrame:
        before = bronze[name].select(F.lit(1).alias("before"), F.lit(0).alias("after"))
        after = silver_tables.counted(name).select(F.lit(0), F.lit(1))
        sums = before.unionAll(after).agg(F.sum("before").alias("bronze"), F.sum("after").alias("silver"))
        return sums.select(
            F.lit(name).alias("table"), "bronze", "silver", (F.col("bronze") - F.col("silver")).alias("removed"))

    return reduce(DataFrame.unionAll, map(counted, BRONZE))


def cleaning_report(bronze: Tables) -> DataFrame:
    """What the rules did to each silver table, observed while its rows are counted.

    Lookups that are left joined by a unique key change no count, so Catalyst drops them.
    """
    lines = []
    for name in SILVER:
        watch = Watch(name)
        rows = Silver(bronze, {name: watch})[name].agg(F.count(F.lit(1))).collect()[0][0]
        lines.append(watch.line(rows))
    return bronze.ventes.sparkSession.createDataFrame(lines, REPORT)


RULES = {
    "clean_blank_default": blank_defaults,
    "clean_numeric_default": numeric_defaults,
    "clean_price_median": price_defaults,
    "fn_text_normalise": normalised_text,
    "fn_to_date": dates_from_text,
    "fn_date_parts": date_parts,
    "fn_round": rounding,
    "enrich_region": regions,
    "dedup_sales": deduplicated_sales,
    "filter_invalid_sales": valid_sales,
    "join_sales_channel": sales_with_channel,
    "join_sales_product": sales_with_product,
    "join_returns_sales": returns_with_sale,
}
