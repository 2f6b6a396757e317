"""The retail model derived from order tables (part, customer, orders, lineitem).

Gives the six bronze frames from a folder of Parquet files, with the gaps,
blanks, bad numbers and repeated keys that the cleaning rules are there for.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comptoir.functions.geography import REGION_CITIES
from comptoir.functions.numbers import MONEY


def city_slots() -> list[str | None]:
    """The mapped cities in mixed case and padding, then a foreign one and blanks."""
    cities = [c for group in REGION_CITIES.values() for c in group]
    spelled = [(c.lower(), f" {c.upper()}", f"{c}  ")[i % 3] for i, c in enumerate(cities)]
    return [*spelled, "paris", "", "   ", None]


def _every(key: str, n: int, rest: int = 0) -> Column:
    return F.col(key) % n == rest


def _twice_if(repeated: Column) -> Column:
    """Explodes to one row, or two where ``repeated``."""
    return F.explode(F.sequence(F.lit(0), F.when(repeated, 1).otherwise(0))).alias("_copy")


class RetailTables:
    """Bronze frames over ``{folder}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._read = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    def ventes(self) -> DataFrame:
        lines = self._read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
        orders = self._read("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        key = F.col("o_orderkey") + F.col("l_partkey")
        seller = F.col("l_suppkey") % 50
        amount = F.col("l_extendedprice").cast(MONEY)
        return lines.join(orders, "o_orderkey").select(
            _sale_id("o_orderkey").alias("vente_id"),
            F.when(key % 211 != 0, F.col("l_shipdate").cast("date")).alias("date_vente"),
            F.when(key % 307 != 0, F.col("o_custkey")).alias("client_id"),
            F.col("l_partkey").alias("produit_id"),
            _channel_id().alias("canal_id"),
            F.when(seller == 0, 0).when(seller != 1, F.col("l_quantity").cast("int")).alias("quantite"),
            F.when(seller == 2, (-amount).cast(MONEY)).when(seller != 3, amount).alias("montant"),
        )

    def produits(self) -> DataFrame:
        part = self._read("part")
        name, price = F.col("p_name"), F.col("p_retailprice").cast(MONEY)
        padded = F.concat(F.lit("  "), name, F.lit("  "))
        return part.select(
            F.col("p_partkey").alias("produit_id"),
            F.when(_every("p_partkey", 47), None).when(_every("p_partkey", 5), padded).otherwise(name).alias("nom"),
            F.when(_every("p_partkey", 37), None).when(_every("p_partkey", 41), "  ")
            .otherwise(F.lower("p_type")).alias("categorie"),
            F.when(_every("p_partkey", 29), None).when(_every("p_partkey", 31), F.lit(0).cast(MONEY))
            .otherwise(price).alias("prix"),
            F.when(_every("p_partkey", 43), "").otherwise(F.lower("p_brand")).alias("marque"),
            _twice_if(_every("p_partkey", 100)),
        ).drop("_copy")

    def clients(self) -> DataFrame:
        slots = F.array(*(F.lit(c) for c in city_slots()))
        number = F.col("c_custkey")
        return self._read("customer").select(
            number.alias("client_id"),
            F.when(~_every("c_custkey", 53), F.col("c_name")).alias("nom"),
            F.when(_every("c_custkey", 59), "").otherwise(F.concat(F.lit("prenom "), number % 17)).alias("prenom"),
            slots[(number % 32).cast("int")].alias("ville"),
            F.when(~_every("c_custkey", 23), F.lower("c_mktsegment")).alias("segment"),
            F.date_add(F.lit("1992-01-01").cast("date"), (number % 1000).cast("int"))
            .cast("string").alias("date_inscription"),
            _twice_if(_every("c_custkey", 100)),
        ).drop("_copy")

    def stocks(self) -> DataFrame:
        depots = [F.struct(F.lit(i).alias("i"), F.lit(d).alias("depot"))
                  for i, d in enumerate(["entrepot nord", " Quai Sud ", "PLATEFORME EST", None])]
        rows = self._read("part").select("p_partkey", F.inline(F.array(*depots)))
        digit, first = F.col("p_partkey") % 10, F.col("i") == 0
        quantity = (
            F.when(digit == 0, -3).when(digit == 1, F.when(first, 1).otherwise(0))
            .when(digit == 2, 1).when(digit == 3, 10)
            .otherwise((F.col("p_partkey") * 7 + F.col("i") * 13) % 97)
        )
        return rows.select(
            F.col("p_partkey").alias("produit_id"), "depot", quantity.cast("int").alias("quantite_disponible"),
            _twice_if(_every("p_partkey", 100, 7) & first),
        ).drop("_copy")

    def retours(self) -> DataFrame:
        reasons = F.array(*map(F.lit, ["casse_transport", "delai_depasse", "article_en_double", "change_avis", "", None]))
        return self._read("lineitem").where("l_returnflag = 'R'").select(
            _sale_id("l_orderkey").alias("retour_id"),
            _sale_id("l_orderkey").alias("vente_id"),
            F.col("l_partkey").alias("produit_id"),
            reasons[(F.col("l_suppkey") % 6).cast("int")].alias("motif"),
            F.date_add(F.col("l_shipdate").cast("date"), 10).alias("date_retour"),
        )

    def canaux(self) -> DataFrame:
        """One row per order priority and status, the last priority left out."""
        name = F.lower(F.substring("o_orderpriority", 3, 40))
        spelled = (
            F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), name, F.lit(" "))).otherwise(name)
        )
        kinds = self._read("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.lit(1).alias("one"))
        return kinds.select(_channel_id().alias("canal_id"), spelled.alias("nom")).where("canal_id <> 5")


def _sale_id(order_key: str) -> Column:
    return F.col(order_key) * 10 + F.col("l_linenumber")


def _channel_id() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")
