"""Literal sample records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import RECORD_SCHEMA

# The sample sources.
SAMPLES = {
    "S1": [
        ("S1-101", "Sharma Medical Store", "Shop 4, Near Gandhi Statue, MG Road, Mumbai", "India"),
        ("S1-102", "Apex Logistics Corp", "1240 Industrial Pkwy, Suite 200, Cleveland, OH", "US"),
        ("S1-103", "Societe Generale Des Eaux SARL", "15 Rue de la Paix, Paris 75002", "France"),
        ("S1-104", "Quick Byte Cafe & Restaurant", "45 Baker St, Opposite City Mall, Bengaluru", "India"),
        ("S1-105", "Global Horizon Financial LLC", "500 5th Ave, 18th Floor, New York, NY", "US"),
    ],
    "S2": [
        ("S2-401", "Sharma Medicos Pvt Ltd", "4 MG Rd, Opp Gandhi Chowk, Bombay", "India"),
        ("S2-402", "Apex Logistics Corporation", "1240 Ind Pkway, Ste 200, Cleveland", "US"),
        ("S2-403", "Ste Generale Eaux", "15 R de la Paix, 75002 Paris", "France"),
        ("S2-404", "Quick Byte Bakers", "45 Baker Street, Near Metro, Bangalore", "India"),
        ("S2-405", "Blue Horizon Financial", "500 5th Avenue, NYC", "US"),
    ],
    "S3": [
        ("S3-701", "Sharma Medical Store & Distributors", "Shop #4 MG Marg, Mumbai", "India"),
        ("S3-702", "Apex Freight Solutions", "1240 Industrial Parkway, OH", "US"),
        ("S3-703", "Societe Generale Des Eaux", "15 Rue de la Paix, Paris", "France"),
        ("S3-704", "Random Food Court", "Baker Street 45, Bengaluru", "India"),
        ("S3-705", "Global Horizon LLC", "5th Ave Fl 18, New York", "US"),
    ],
}
# Two typed records for the comparison page.
TYPED = (
    ("Societe Nouvelle de Transports SARL", "24 Boulevard Haussmann, Paris 75009"),
    ("Ste Nlle Transports SA", "24 Bd Haussmann, 75009 Paris"),
)


def sample(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame(SAMPLES[source], RECORD_SCHEMA)
