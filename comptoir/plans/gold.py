"""Gold layer: fifteen tables over silver.

Builders keep no row order; sort when reading. ``ventes`` is silver_ventes or,
for the builders that only need sums, a roll-up of it from
``comptoir.operators.totals.roll_up`` at the named grain or finer. Large tables
are aggregated by their key first and joined to dimensions afterwards. All
builders are lazy but product_affinity, which writes its counts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.functions.calendar import month_columns, month_start, week_columns
from comptoir.functions.numbers import money, percent, ratio
from comptoir.operators import totals as t
from comptoir.operators.pairs import OUTRIGHT, item_counts, rows_of_pairs, top_pairs, top_pairs_by_item
from comptoir.operators.quantiles import quantiles
from comptoir.sources.stores import written

# Labels as they are stored and filtered on.
RUPTURE, CRITIQUE, FAIBLE, NORMAL, SUR_STOCK = (
    "🔴 RUPTURE", "🟠 CRITIQUE", "🟡 FAIBLE", "🟢 NORMAL", "🔵 SUR-STOCK")
CHAMPION, FIDELE, A_RISQUE, POTENTIEL, NOUVEAU, PERDU = (
    "💎 Champion", "⭐ Fidèle", "😴 A Risque", "📈 Potentiel", "🆕 Nouveau", "💤 Perdu")

#: Error of rank of the quartiles where they are estimated.
RFM_ERROR = 0.05

PRODUCT = ["nom", "categorie", "marque"]
CLIENT = ["nom", "prenom", "ville", "segment", "region"]


# -- revenue over time (grain: date_vente, and the named dimension) -----------

def ca_daily(ventes: DataFrame) -> DataFrame:
    return t.roll_up(ventes, "date_vente").select("date_vente", *t.four_measures())


def ca_weekly(ventes: DataFrame) -> DataFrame:
    weeks = t.roll_up(ventes, *week_columns(F.col("date_vente")))
    return weeks.select("annee", "semaine", *t.four_measures())


def ca_monthly(ventes: DataFrame) -> DataFrame:
    months = t.roll_up(ventes, month_start(F.col("date_vente")).alias("month"))
    return months.select(*month_columns(F.col("month")), *t.four_measures())


def ca_by_canal(ventes: DataFrame) -> DataFrame:
    """With the share of each channel. The window sees one row per channel."""
    channels = t.roll_up(ventes, "canal_id", "nom_canal")
    whole = F.sum(t.AMOUNT).over(Window.partitionBy())
    share = percent(F.round(t.AMOUNT, 2), whole).alias("part_ca_pct")
    return channels.select("canal_id", "nom_canal", *t.four_measures(), share)


def sales_by_category(ventes: DataFrame) -> DataFrame:
    months = t.roll_up(ventes, month_start(F.col("date_vente")).alias("month"), "categorie_produit")
    return months.select(
        *month_columns(F.col("month")), "categorie_produit", t.revenue(), t.sales(), t.units())


def canal_performance(ventes: DataFrame) -> DataFrame:
    """Monthly revenue of a channel and its growth over its previous month.

    ``ventes`` may be ``roll_up_clients`` by day and channel; so in ``daily_trend``.
    """
    rolled = t.roll_up_clients(ventes, month_start(F.col("date_vente")).alias("month"), "canal_id", "nom_canal")
    months = t.count_clients(rolled, "month", "canal_id", "nom_canal", name="nb_clients_uniques")
    before = F.lag(t.AMOUNT).over(Window.partitionBy("canal_id").orderBy("month"))
    growth = F.when(F.col("before") > 0, percent(F.col(t.AMOUNT) - F.col("before"), F.col("before")))
    return months.withColumn("before", before).select(
        *month_columns(F.col("month")), "canal_id", "nom_canal",
        t.revenue(), t.sales(), t.basket(), "nb_clients_uniques",
        money(F.col("before")).alias("ca_mois_precedent"), growth.alias("croissance_pct"),
    )


def daily_trend(ventes: DataFrame, calendar: bool = False) -> DataFrame:
    """Moving averages over the last 7 and 30 rows, that is, days with sales.

    ``calendar=True`` takes calendar days instead. The windows have no key, but
    run over one row per day, never over sales.
    """
    days = t.count_clients(t.roll_up_clients(ventes, "date_vente"), "date_vente", name="nb_clients_actifs")

    def moving(length: int):
        if calendar:
            span = Window.orderBy(F.unix_date("date_vente")).rangeBetween(1 - length, 0)
        else:
            span = Window.orderBy("date_vente").rowsBetween(1 - length, 0)
        return ratio(F.sum(t.AMOUNT).over(span), F.count(t.AMOUNT).over(span))

    so_far = Window.orderBy("date_vente").rowsBetween(Window.unboundedPreceding, 0)
    return days.select(
        "date_vente", t.revenue("ca_jour"), t.sales(), "nb_clients_actifs",
        moving(7).alias("moyenne_mobile_7j"), moving(30).alias("moyenne_mobile_30j"),
        money(F.sum(t.AMOUNT).over(so_far)).alias("ca_cumule"),
    )


# -- clients (grain: client_id) ------------------------------------------------

def sales_by_region(ventes: DataFrame, clients: DataFrame) -> DataFrame:
    places = clients.select("client_id", "region", "ville")
    per_client = t.roll_up(ventes, "client_id").join(places, "client_id", "left")
    return t.roll_up(per_client, "region", "ville").select("region", "ville", *t.four_measures())


def customer_basket(ventes: DataFrame, clients: DataFrame) -> DataFrame:
    per_client = t.roll_up(ventes, "client_id").join(clients.select("client_id", *CLIENT), "client_id", "left")
    return per_client.select(
        "client_id", *CLIENT, t.sales("nb_achats"), t.revenue("ca_total_client"),
        t.basket(), t.units("total_articles"))


def sales_by_segment(ventes: DataFrame, clients: DataFrame) -> DataFrame:
    """Active clients are counted as the rows of the per-client roll-up."""
    per_client = t.roll_up(ventes, "client_id").join(clients.select("client_id", "segment"), "client_id", "left")
    segments = per_client.groupBy("segment").agg(
        *t.partial_sums(), F.count("client_id").alias("nb_clients_actifs"))
    return segments.select("segment", *t.four_measures(), "nb_clients_actifs")


def client_rfm(per_client: DataFrame, clients: DataFrame, exact: bool = True) -> DataFrame:
    """Recency, frequency and spend, scored 1 to 4 by quartile.

    ``per_client`` is ``roll_up(ventes, "client_id", days=True)``. It is read
    several times, so it should be a stored table.
    """
    cut = rfm_cuts(per_client, exact)
    raw = per_client.select(
        "client_id", F.lit(_last_day(per_client)).alias("today"), t.LAST, t.SALES,
        F.round(t.AMOUNT, 2).alias("spent"), cut.alias("cut"))
    scored = raw.withColumns({
        "r_score": _quartile(F.unix_date(t.LAST), F.col("cut.last_day")),
        "f_score": _quartile(F.col(t.SALES), F.col("cut.sales")),
        "m_score": _quartile(F.col("spent") * 100, F.col("cut.cents")),
    }).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return scored.join(clients.select("client_id", *CLIENT), "client_id", "left").select(
        "client_id", F.datediff("today", t.LAST).alias("recence_jours"), t.sales("frequence"),
        money(F.col("spent")).alias("montant_total"), "r_score", "f_score", "m_score", "rfm_score",
        rfm_segment(F.col("rfm_score"), F.col("r_score")).alias("rfm_segment"), *CLIENT,
    )


def _last_day(per_client: DataFrame) -> Column:
    return per_client.agg(F.max(t.LAST)).scalar()


def rfm_cuts(per_client: DataFrame, exact: bool = True) -> Column:
    """Scalar struct of the quartiles: last sale as day number, sales, spend in cents.

    Recency is the distance to one fixed day, so its quartiles are those of the
    last sale from the latest down: cut 0 of recency is the last of ``last_day``.
    """
    backwards = -F.unix_date(t.LAST)
    found = quantiles(
        per_client,
        {"backwards": backwards, "sales": F.col(t.SALES), "cents": F.round(t.AMOUNT, 2) * 100},
        [0.25, 0.5, 0.75], exact, RFM_ERROR)
    last_day = F.array(*(-F.col("backwards")[i] for i in (2, 1, 0))).alias("last_day")
    return found.select(F.struct(last_day, "sales", "cents")).scalar()


def rfm_quartiles(per_client: DataFrame) -> DataFrame:
    """quartile, recence, frequence, montant: the cuts behind the scores."""
    cuts = per_client.sparkSession.range(1).select(
        rfm_cuts(per_client).alias("cut"), F.unix_date(_last_day(per_client)).alias("today"))
    rows = [
        F.struct(F.lit(i + 1).alias("quartile"), (F.col("today") - F.col("cut.last_day")[2 - i]).cast("int").alias("recence"),
                 F.col("cut.sales")[i].alias("frequence"), (F.col("cut.cents")[i] / 100).alias("montant"))
        for i in range(3)
    ]
    return cuts.select(F.inline(F.array(*rows)))


def _quartile(value: Column, cuts: Column) -> Column:
    """1 plus the number of quartile cuts that the value has reached."""
    reached = [(value >= cuts[i]).cast("int") for i in range(3)]
    return F.lit(1) + reached[0] + reached[1] + reached[2]


def rfm_segment(score, recency):
    recent = recency >= 3
    return (
        F.when(score >= 11, CHAMPION)
        .when(score >= 9, F.when(recent, FIDELE).otherwise(A_RISQUE))
        .when(score >= 7, POTENTIEL)
        .otherwise(F.when(recent, NOUVEAU).otherwise(PERDU))
    )


# -- products (grain: produit_id) ----------------------------------------------

def top_products(ventes: DataFrame, produits: DataFrame, k: int = 10) -> DataFrame:
    """The k products sold most; equal quantities share a rank."""
    best_first = F.desc_nulls_last(t.UNITS)
    best = t.roll_up(ventes, "produit_id").orderBy(best_first, "produit_id").limit(k)
    ranked = best.withColumn("rang", F.rank().over(Window.orderBy(best_first)))
    return ranked.join(produits.select("produit_id", *PRODUCT, "prix"), "produit_id", "left").select(
        "produit_id", *PRODUCT, F.col("prix").cast("double").alias("prix"),
        t.units("total_quantite_vendue"), t.revenue(), t.sales("nb_transactions"), t.basket(), "rang",
    )


def return_rate(ventes: DataFrame, retours: DataFrame, produits: DataFrame) -> DataFrame:
    """Products with sales. A rate can exceed 100: returns count by their own product."""
    sold = t.roll_up(ventes, "produit_id")
    returned = retours.groupBy("produit_id").agg(
        F.count("retour_id").alias("returns"), F.sum("montant_retour").alias("refunds"))
    per_product = sold.join(returned, "produit_id", "left").join(
        produits.select("produit_id", *PRODUCT), "produit_id", "left")
    returns = F.coalesce("returns", F.lit(0))
    return per_product.select(
        "produit_id", t.sales(), t.revenue(), returns.alias("nb_retours"),
        F.coalesce(money(F.col("refunds")), F.lit(0.0)).alias("montant_retours"),
        *PRODUCT, percent(returns, F.col(t.SALES)).alias("taux_retour_pct"),
    )


def stock_alert(stocks: DataFrame, ventes: DataFrame, produits: DataFrame) -> DataFrame:
    """Products with stock, by how long the stock lasts at the mean daily pace.

    A roll-up passed as ``ventes`` needs ``days=True``. It is read twice, so it
    should be a stored table.
    """
    held = stocks.groupBy("produit_id").agg(F.sum("quantite_disponible").alias("stock_total"))
    sold = t.roll_up(ventes, "produit_id", days=True)
    days = sold.agg(F.greatest(F.datediff(F.max(t.LAST), F.min(t.FIRST)), F.lit(1))).scalar()
    pace = sold.select("produit_id", t.units("sold"), ratio(F.col(t.UNITS), days).alias("pace"))
    per_product = held.join(pace, "produit_id", "left").join(
        produits.select("produit_id", *PRODUCT, "prix"), "produit_id", "left")
    lasting = per_product.withColumns({
        "total_vendu": F.coalesce("sold", F.lit(0)),
        "ventes_par_jour": F.coalesce("pace", F.lit(0.0)),
    }).withColumn(
        "jours_de_stock",
        F.when(F.col("ventes_par_jour") > 0, ratio(F.col("stock_total"), F.col("ventes_par_jour"), 0))
        .otherwise(F.lit(9999.0)),
    )
    return lasting.select(
        "produit_id", "stock_total", "total_vendu", "ventes_par_jour", *PRODUCT,
        F.col("prix").cast("double").alias("prix"), "jours_de_stock",
        alert_level(F.col("stock_total"), F.col("jours_de_stock")).alias("alerte"),
        money(F.col("stock_total") * F.col("prix")).alias("valeur_stock"),
    )


def alert_level(stock, days_left):
    return (
        F.when(stock == 0, RUPTURE)
        .when(days_left <= 7, CRITIQUE)
        .when(days_left <= 30, FAIBLE)
        .when(days_left >= 365, SUR_STOCK)
        .otherwise(NORMAL)
    )


def product_affinity(ventes: DataFrame, distinct_clients: bool = False) -> DataFrame:
    """The 100 product pairs bought most by the same clients, seen at least twice.

    Counts pairs of sales; ``distinct_clients=True`` counts clients.
    """
    counts = written(item_counts(ventes, "client_id", "produit_id", "categorie_produit", distinct_clients), "pair-counts")
    pairs_of = top_pairs_by_item if rows_of_pairs(counts) > OUTRIGHT else top_pairs
    pairs = pairs_of(counts, limit=100, at_least=2)
    return pairs.select(
        F.col("a").alias("produit_a"), F.col("label_a").alias("categorie_a"),
        F.col("b").alias("produit_b"), F.col("label_b").alias("categorie_b"),
        F.col("score").alias("nb_clients_communs"))


# -- status counts --------------------------------------------------------------

def status_counts(stock_alert: DataFrame, client_rfm: DataFrame) -> DataFrame:
    """How many products are out of or low on stock, how many clients best or lost."""
    def counted(df: DataFrame, table: str, column: str, *wanted: str) -> DataFrame:
        cells = [F.struct(F.lit(table).alias("table"), F.lit(w).alias("statut"),
                          F.count_if(F.col(column) == w).alias("nb")) for w in wanted]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    return counted(stock_alert, "gold_stock_alert", "alerte", RUPTURE, CRITIQUE).unionAll(
        counted(client_rfm, "gold_client_rfm", "rfm_segment", CHAMPION, PERDU))
