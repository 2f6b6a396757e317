"""Reports come out in their stated order, ties settled, however the work is split."""

from __future__ import annotations

import pytest

from comptoir.plans.serving import REPORTS

#: Sort columns of the reports that show them: descending where marked.
ORDERS = {
    "q_by_channel": ["-ca_total", "nom_canal"],
    "q_region": ["-ca_region", "region"],
    "q_segment_share": ["-ca_total", "segment"],
    "q_rfm_summary": ["-ca_segment", "rfm_segment"],
    "q_champions": ["-montant_total"],
    "q_winback": ["-montant_total"],
    "q_return_category": ["-taux_retour_pct", "categorie"],
    "q_stock_critical": ["jours_de_stock"],
}


def sort_key(columns):
    """Nulls last; a stable sort leaves ties as they came."""
    def part(row, column):
        value = row[column.lstrip("-")]
        return value is None, 0 if value is None else -value if column[0] == "-" else value

    return lambda row: [part(row, column) for column in columns]


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_sorted(house, name):
    rows = REPORTS[name](house.gold).collect()
    assert rows == sorted(rows, key=sort_key(ORDERS[name]))


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_ties_do_not_depend_on_the_partitions(house, conf, name):
    first = REPORTS[name](house.gold).collect()
    conf("spark.sql.shuffle.partitions", "3")
    assert REPORTS[name](house.gold).collect() == first
