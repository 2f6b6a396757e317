"""Silver layer: one builder per table, each from bronze frames.

Rules apply in the order written; a default set before a case change is
changed with the rest of the column. Lookups take the raw values of the other
bronze table, one row per key, so repeated lookup rows never multiply facts.
``watch`` observes what the rules do while the table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comptoir.functions.calendar import to_day
from comptoir.functions.geography import region_of
from comptoir.functions.numbers import MONEY, not_negative, positive_or
from comptoir.functions.text import capitals, or_default, title
from comptoir.operators.dedup import one_per_key
from comptoir.operators.lookups import lookup_join
from comptoir.operators.marks import key_marks, may_hold
from comptoir.operators.quantiles import quantiles
from comptoir.plans.watch import COPIES, Watch
from comptoir.sources.lineage import without_lineage
from comptoir.sources.schemas import REQUIRED, columns_of


def survivors(bronze: DataFrame, table: str, *keys: str, watch: Watch | None = None) -> DataFrame:
    """One row per key of a bronze table, the most complete one."""
    rows, rule = without_lineage(bronze), {"required": REQUIRED.get(table, ()), "order": columns_of(table)}
    return watch(one_per_key(rows, *keys, copies=COPIES, **rule)) if watch else one_per_key(rows, *keys, **rule)


def clients(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    known = survivors(bronze, "clients", "client_id", watch=watch)
    cleaned = known.withColumns({
        "ville": title(or_default(F.col("ville"), "Inconnu")),
        "segment": capitals(or_default(F.col("segment"), "Standard")),
        "nom": capitals(or_default(F.col("nom"), "Inconnu")),
        "prenom": title(or_default(F.col("prenom"), "Inconnu")),
        "date_inscription": to_day(F.col("date_inscription")),
    })
    return cleaned.withColumn("region", region_of(F.col("ville")))


def median_price(bronze_produits: DataFrame, exact: bool = True):
    """Scalar: median of all prices that are not null, repeated rows included."""
    cents = (F.col("prix").cast(MONEY) * 100).cast("long")
    middle = quantiles(bronze_produits, {"cents": cents}, [0.5], exact)
    return middle.select((F.col("cents")[0] / 100).cast(MONEY)).scalar()


def produits(bronze: DataFrame, exact_median: bool = True, watch: Watch | None = None) -> DataFrame:
    price = F.col("prix").cast(MONEY)
    return survivors(bronze, "produits", "produit_id", watch=watch).withColumns({
        "categorie": title(or_default(F.col("categorie"), "Non classé")),
        "marque": title(or_default(F.col("marque"), "Inconnue")),
        "nom": F.trim(or_default(F.col("nom"), "Produit Inconnu")),
        "prix": positive_or(price, median_price(bronze, exact_median)),
    })


def sales_without_lookups(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Deduplicated, repaired sales that have a date, a client and a product."""
    repaired = survivors(bronze, "ventes", "vente_id", watch=watch).withColumns({
        "date_vente": to_day(F.col("date_vente")),
        "montant": positive_or(F.col("montant").cast(MONEY), F.lit(0).cast(MONEY)),
        "quantite": positive_or(F.col("quantite"), F.lit(1)),
    })
    return repaired.dropna(subset=["date_vente", "client_id", "produit_id"])


def counted_sales(bronze: DataFrame) -> DataFrame:
    """A row per row of silver_ventes, with only the columns that decide which sales are kept.

    Copies are compared by these columns first, so the others, which would be
    sorted with them, cannot change what the copy that is kept has here.
    """
    decisive = REQUIRED["ventes"]
    kept = survivors(bronze.select("vente_id", *decisive), "ventes", "vente_id")
    return kept.withColumn("date_vente", to_day(F.col("date_vente"))).dropna(subset=list(decisive))


def with_channel(ventes: DataFrame, bronze_canaux: DataFrame) -> DataFrame:
    known = survivors(bronze_canaux, "canaux", "canal_id")
    names = known.select("canal_id", capitals(F.col("nom")).alias("nom_canal"))
    return lookup_join(ventes, names, "canal_id").fillna("INCONNU", "nom_canal")


def with_product(ventes: DataFrame, bronze_produits: DataFrame) -> DataFrame:
    known = survivors(bronze_produits, "produits", "produit_id")
    goods = known.select(
        "produit_id", title(F.col("categorie")).alias("categorie_produit"), F.col("prix").alias("prix_unitaire")
    )
    return lookup_join(ventes, goods, "produit_id").fillna("Non classé", "categorie_produit")


def ventes(
    bronze: DataFrame, bronze_canaux: DataFrame, bronze_produits: DataFrame, watch: Watch | None = None,
) -> DataFrame:
    kept = sales_without_lookups(bronze, watch)
    return with_product(with_channel(kept, bronze_canaux), bronze_produits)


def stocks(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    return survivors(bronze, "stocks", "produit_id", "depot", watch=watch).withColumns({
        "depot": title(or_default(F.col("depot"), "Dépôt Inconnu")),
        "quantite_disponible": not_negative(F.col("quantite_disponible")),
    })


def returns_without_lookups(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    return survivors(bronze, "retours", "retour_id", watch=watch).withColumns({
        "date_retour": to_day(F.col("date_retour")),
        "motif": title(or_default(F.col("motif"), "Non spécifié")),
    })


def returned(bronze_ventes: DataFrame, wanted: DataFrame, many: bool = False) -> DataFrame:
    """The sales whose ``vente_id`` is among the wanted ones.

    Few ids are broadcast, so the others go in the scan. If they are too ``many``
    for that, most others go there by marks of the ids, and are not shuffled.
    """
    near = bronze_ventes.where(may_hold(key_marks(wanted), F.col("vente_id"))) if many else bronze_ventes
    return near.join(wanted, "vente_id", "left_semi")


def with_sale(
    retours: DataFrame, bronze_ventes: DataFrame, bronze_retours: DataFrame | None = None, many: bool = False,
) -> DataFrame:
    """The raw sale of each return, chosen as in silver_ventes when repeated.

    Few sales are returned, so the others go before the survivors are chosen;
    which are returned is read from ``bronze_retours`` where that is cheaper.
    Both sides of the last join are nearly unique by key and are placed by it
    already, so it needs no shuffle of the sales.
    """
    wanted = (retours if bronze_retours is None else bronze_retours).select("vente_id").dropna().distinct()
    sold = survivors(returned(bronze_ventes, wanted, many), "ventes", "vente_id").select(
        "vente_id", F.col("montant").cast(MONEY).alias("montant_retour"), "canal_id", "client_id"
    )
    zero = F.lit(0).cast(MONEY)
    joined = retours.join(sold, "vente_id", "left").withColumn("montant_retour", F.coalesce("montant_retour", zero))
    return joined.select(*retours.columns, "montant_retour", "canal_id", "client_id")


def retours(bronze: DataFrame, bronze_ventes: DataFrame, watch: Watch | None = None, many: bool = False) -> DataFrame:
    """``many``: the returns are too many to be broadcast; it changes the plan only."""
    return with_sale(returns_without_lookups(bronze, watch), bronze_ventes, bronze, many)


def canaux(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    known = survivors(bronze, "canaux", "canal_id", watch=watch)
    return known.withColumn("nom", or_default(capitals(F.col("nom")), "INCONNU"))
