"""Text labels and the fixed lookups behind the state map and the risk matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.functions.numeric import first_match

# Brazilian state code, name, map latitude, map longitude.
BRAZIL_STATES = [
    ("AC", "Acre", -9.02, -70.81),
    ("AL", "Alagoas", -9.57, -36.78),
    ("AM", "Amazonas", -4.00, -61.99),
    ("AP", "Amapá", 0.90, -52.00),
    ("BA", "Bahia", -12.57, -41.70),
    ("CE", "Ceará", -5.50, -39.32),
    ("DF", "Distrito Federal", -15.78, -47.93),
    ("ES", "Espírito Santo", -19.19, -40.34),
    ("GO", "Goiás", -15.83, -49.98),
    ("MA", "Maranhão", -4.96, -45.27),
    ("MG", "Minas Gerais", -18.10, -44.38),
    ("MS", "Mato Grosso do Sul", -20.51, -54.54),
    ("MT", "Mato Grosso", -12.64, -55.42),
    ("PA", "Pará", -3.79, -52.48),
    ("PB", "Paraíba", -7.06, -36.55),
    ("PE", "Pernambuco", -8.81, -36.95),
    ("PI", "Piauí", -7.72, -42.73),
    ("PR", "Paraná", -24.89, -51.55),
    ("RJ", "Rio de Janeiro", -22.25, -42.66),
    ("RN", "Rio Grande do Norte", -5.84, -36.53),
    ("RO", "Rondônia", -10.83, -63.34),
    ("RR", "Roraima", 2.07, -61.40),
    ("RS", "Rio Grande do Sul", -30.03, -53.23),
    ("SC", "Santa Catarina", -27.45, -50.95),
    ("SE", "Sergipe", -10.57, -37.45),
    ("SP", "São Paulo", -22.19, -48.79),
    ("TO", "Tocantins", -10.18, -48.33),
]

# Rating -> score; anything else counts as Low.
LEVEL_SCORES = {"Low": 1, "Medium": 2, "High": 3}


def title_label(value: Column) -> Column:
    """'bed_bath_table' -> 'Bed Bath Table'; a capital follows anything but a letter."""
    mark = "\x01 "  # initcap wants a blank before a capital
    parted = F.regexp_replace(F.replace(value, F.lit("_"), F.lit(" ")), r"([^\p{L}])(\p{L})", f"$1{mark}$2")
    return F.replace(F.initcap(parted), F.lit(mark), F.lit(""))


def level_score(level: Column) -> Column:
    return first_match(
        [(level == name, F.lit(score)) for name, score in LEVEL_SCORES.items() if name != "Low"],
        F.lit(LEVEL_SCORES["Low"]),
    )


def risk_level(score: Column) -> Column:
    return first_match([(score >= 6, F.lit("High")), (score >= 3, F.lit("Medium"))], F.lit("Low"))


def state_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BRAZIL_STATES, "state string, state_name string, lat double, lng double")
