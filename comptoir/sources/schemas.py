"""Columns of the six landing tables.

Keys are BIGINT, since sales outgrow 32 bits; money is DECIMAL.
"""

from __future__ import annotations

import re

SCHEMAS = {
    "clients": "client_id BIGINT, nom STRING, prenom STRING, ville STRING, segment STRING, date_inscription STRING",
    "produits": "produit_id BIGINT, nom STRING, categorie STRING, prix DECIMAL(18,2), marque STRING",
    "ventes": (
        "vente_id BIGINT, date_vente DATE, client_id BIGINT, produit_id BIGINT, canal_id INT,"
        " quantite INT, montant DECIMAL(18,2)"
    ),
    "stocks": "produit_id BIGINT, depot STRING, quantite_disponible INT",
    "retours": "retour_id BIGINT, vente_id BIGINT, produit_id BIGINT, motif STRING, date_retour DATE",
    "canaux": "canal_id INT, nom STRING",
}

#: Columns without which a row is of no use to the silver layer.
REQUIRED = {"ventes": ("date_vente", "client_id", "produit_id")}


def _declared(table: str) -> dict[str, str]:
    return dict(part.split() for part in re.split(r",(?![^(]*\))", SCHEMAS[table]))


def columns_of(table: str) -> list[str]:
    """The declared columns, in order."""
    return list(_declared(table))


def type_of(table: str, column: str) -> str:
    return _declared(table)[column]
