"""City to sales region."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The region of each city, as the cleaned city name is spelled.
REGION_CITIES = {
    "Casablanca-Settat": ["Casablanca", "Mohammedia", "Settat", "El Jadida"],
    "Rabat-Salé-Kénitra": ["Rabat", "Salé", "Kenitra", "Skhirate"],
    "Fès-Meknès": ["Fès", "Meknès", "Ifrane", "Taza"],
    "Marrakech-Safi": ["Marrakech", "Safi", "Essaouira", "Kelaa"],
    "Tanger-Tétouan-Al Hoceima": ["Tanger", "Tétouan", "Al Hoceima", "Larache"],
    "Souss-Massa": ["Agadir", "Tiznit", "Taroudant", "Ouarzazate"],
    "Oriental": ["Oujda", "Nador", "Berkane", "Taourirt"],
}
OTHER_REGION = "Autres"


def region_of(ville: Column) -> Column:
    matches = [F.when(ville.isin(cities), region) for region, cities in REGION_CITIES.items()]
    return F.coalesce(*matches, F.lit(OTHER_REGION))
