"""Sales measures as partial sums that can be rolled up again.

A *facts* frame has four partial columns per row. ``as_facts`` makes one from
silver sales (one row per sale); ``roll_up`` adds partials up to any grain, and
takes silver sales, or an earlier roll-up of them, alike. So a large table is
aggregated by key before it meets a dimension, and several gold tables can be
built from one small roll-up. ``roll_up_clients`` also keeps which clients
bought, so that distinct clients can be counted at any coarser grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from comptoir.functions.numbers import money, ratio

AMOUNT, AMOUNTS, SALES, UNITS = "_amount", "_amounts", "_sales", "_units"
FIRST, LAST = "_first_day", "_last_day"
BUCKET, CLIENTS = "_bucket", "_clients"


def as_facts(ventes: DataFrame) -> DataFrame:
    if AMOUNT in ventes.columns:
        return ventes
    one_if = lambda name: F.col(name).isNotNull().cast("long")
    return ventes.withColumns({
        AMOUNT: F.col("montant"),
        AMOUNTS: one_if("montant"),
        SALES: one_if("vente_id"),
        UNITS: F.col("quantite").cast("long"),
        FIRST: F.col("date_vente"),
        LAST: F.col("date_vente"),
    })


def partial_sums(days: bool = False) -> list[Column]:
    sums = [F.sum(c).alias(c) for c in (AMOUNT, AMOUNTS, SALES, UNITS)]
    span = [F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)]
    return sums + span if days else sums


def roll_up(ventes: DataFrame, *keys: str | Column, days: bool = False) -> DataFrame:
    """Partials per key; ``days`` also keeps the first and last sale date."""
    return as_facts(ventes).groupBy(*keys).agg(*partial_sums(days))


def roll_up_clients(ventes: DataFrame, *keys: str | Column) -> DataFrame:
    """Partials per key and bucket of clients, with the bucket's clients as a bitmap.

    Exact distinct counts do not add up, bitmaps do: those of an earlier
    ``roll_up_clients`` are merged. A bucket is a range of 32,768 client ids, so
    a row has four kilobytes at most, which compress well where few are set.
    """
    if CLIENTS in ventes.columns:
        return ventes.groupBy(*keys, BUCKET).agg(*partial_sums(), F.bitmap_or_agg(CLIENTS).alias(CLIENTS))
    bucket = F.bitmap_bucket_number("client_id").alias(BUCKET)
    clients = F.bitmap_construct_agg(F.bitmap_bit_position("client_id")).alias(CLIENTS)
    return as_facts(ventes).groupBy(*keys, bucket).agg(*partial_sums(), clients)


def count_clients(rolled: DataFrame, *keys: str, name: str) -> DataFrame:
    """Partials per key and ``name``, the distinct clients, of a ``roll_up_clients`` by these keys."""
    return rolled.groupBy(*keys).agg(*partial_sums(), F.sum(F.bitmap_count(CLIENTS)).alias(name))


def revenue(name: str = "ca_total") -> Column:
    return money(F.col(AMOUNT)).alias(name)


def sales(name: str = "nb_ventes") -> Column:
    return F.col(SALES).alias(name)


def basket(name: str = "panier_moyen") -> Column:
    return ratio(F.col(AMOUNT), F.col(AMOUNTS)).alias(name)


def units(name: str = "total_quantite") -> Column:
    return F.col(UNITS).alias(name)


def four_measures() -> list[Column]:
    return [revenue(), sales(), basket(), units()]
