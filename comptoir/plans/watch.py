"""What the cleaning rules did to a table, observed while it is written."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from comptoir.functions.calendar import to_day

REPORT = "table STRING, read BIGINT, duplicate BIGINT, defaulted BIGINT, clamped BIGINT, dropped BIGINT, written BIGINT"
COPIES = "_copies"

_blank = lambda name: ~F.coalesce(F.length(F.trim(name)) > 0, F.lit(False))
_not_positive = lambda name: ~F.coalesce(F.col(name) > 0, F.lit(False))


def _conditions(table: str) -> tuple[tuple[Column, ...], tuple[Column, ...], tuple[Column, ...]]:
    """(defaulted cells, clamped cells, dropped rows) of a row of the bronze table."""
    blank = {
        "clients": ("ville", "segment", "nom", "prenom"), "produits": ("categorie", "marque", "nom"),
        "stocks": ("depot",), "retours": ("motif",), "canaux": ("nom",),
    }.get(table, ())
    defaulted = [_blank(c) for c in blank]
    clamped, dropped = [], []
    if table == "produits":
        defaulted.append(_not_positive("prix"))
    if table == "ventes":
        defaulted += [_not_positive("montant"), _not_positive("quantite")]
        dropped = [to_day(F.col("date_vente")).isNull(), F.col("client_id").isNull(), F.col("produit_id").isNull()]
    if table == "stocks":
        defaulted.append(F.col("quantite_disponible").isNull())
        clamped.append(F.col("quantite_disponible") < 0)
    return tuple(defaulted), tuple(clamped), tuple(dropped)


class Watch:
    """Counts at one point of the plan of a silver table: after its repeated keys are settled.

    The counts come with the job that evaluates the plan. Tasks that are run
    again after an executor is lost may count twice; the written rows do not
    depend on it.
    """

    def __init__(self, table: str):
        self.table = table
        self._seen = Observation()

    def __call__(self, kept: DataFrame) -> DataFrame:
        """``kept`` has one row per key and the column ``COPIES``, which goes."""
        defaulted, clamped, dropped = _conditions(self.table)
        cells = lambda conditions: F.sum(reduce(add, (c.cast("long") for c in conditions), F.lit(0).cast("long")))
        return kept.observe(
            self._seen, F.sum(COPIES).alias("read"), F.count(F.lit(1)).alias("kept"),
            cells(defaulted).alias("defaulted"), cells(clamped).alias("clamped"),
            F.count_if(reduce(or_, dropped, F.lit(False))).alias("dropped"),
        ).drop(COPIES)

    def line(self, written: int) -> tuple:
        """A row of the report; the plan must have been evaluated once."""
        seen = {name: n or 0 for name, n in self._seen.get.items()}
        return (self.table, seen["read"], seen["read"] - seen["kept"], seen["defaulted"], seen["clamped"], seen["dropped"], written)
