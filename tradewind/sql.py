"""SQL over the warehouse: the tables by name, and the library's own expressions as SQL functions.

Stored tables are there as ``database.table``; frames that aren't stored go in as views. The functions
round, count months, name days and delays as the operators do, so that a statement gives their results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tradewind.functions import dates, labels, numeric
from tradewind.plans.marts import DELIVERY_BUCKETS

# name -> parameters, type and expression; each says the same as the Python expression of that name.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "scaled_round": ("x DOUBLE, digits INT", "DOUBLE", "round(x * power(10D, digits), 0) / power(10D, digits)"),
    "even_round": ("x DOUBLE, digits INT", "DOUBLE", "rint(x * power(10D, digits)) / power(10D, digits)"),
    "ratio": ("part DOUBLE, whole DOUBLE", "DOUBLE", "part / nullif(whole, 0D)"),
    "pct": ("part DOUBLE, whole DOUBLE", "DOUBLE", "100D * part / nullif(whole, 0D)"),
    "date_key": ("day DATE", "INT", "year(day) * 10000 + month(day) * 100 + dayofmonth(day)"),
    "weekday_from_sunday": ("day DATE", "INT", "dayofweek(day) - 1"),
    "month_boundaries": ("first DATE, last DATE", "INT", "(year(last) - year(first)) * 12 + month(last) - month(first)"),
    "month_label": ("year INT, month INT", "STRING", "concat_ws('-', year, lpad(cast(month AS STRING), 2, '0'))"),
    "delivery_bucket": (
        "days INT",
        "STRING",
        "CASE "
        + " ".join(f"WHEN days <= {most} THEN '{name}'" for name, most in DELIVERY_BUCKETS if most is not None)
        + f" ELSE '{DELIVERY_BUCKETS[-1][0]}' END",
    ),
    "level_score": (
        "level STRING",
        "INT",
        "CASE level " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in labels.LEVEL_SCORES.items()) + " ELSE 1 END",
    ),
}

# The same as expressions on columns, for whoever mixes both.
EXPRESSIONS = {
    "scaled_round": numeric.round_half_away,
    "even_round": numeric.round_half_even,
    "ratio": numeric.safe_ratio,
    "pct": numeric.percent,
    "date_key": dates.date_key,
    "weekday_from_sunday": dates.weekday_from_sunday,
    "month_boundaries": dates.month_boundaries,
    "month_label": dates.month_label,
    "level_score": labels.level_score,
}


class Sql:
    """Statements over the layers of the pipeline.

    ``layers`` maps a layer's name to its tables, a catalog database or frames. A table ``t`` of the layer ``marts`` is
    ``marts.t`` in a statement; frames are registered as views of the name ``marts__t``, which a statement
    reaches as ``{marts}.t`` as well as a database.
    """

    def __init__(self, spark: SparkSession, **layers: str | Mapping[str, DataFrame]):
        self.spark, self.layers = spark, {}
        for name, (parameters, kind, body) in FUNCTIONS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
        for layer, tables in layers.items():
            if isinstance(tables, str):
                self.layers[layer] = f"`{tables}`."
                continue
            for table, df in tables.items():
                df.createOrReplaceTempView(f"{layer}__{table}")
            self.layers[layer] = f"{layer}__"

    def q(self, statement: str, **parameters) -> DataFrame:
        """The rows of a statement; ``{layer}.`` before a table names its layer, ``:name`` a parameter."""
        for layer, prefix in self.layers.items():
            statement = statement.replace(f"{{{layer}}}.", prefix)
        return self.spark.sql(statement, args=parameters or None)

    def fetch(self, statement: str, most: int = 100_000, **parameters) -> list[Row]:
        """The rows on the driver; a result of more than ``most`` rows is refused, never cut."""
        rows = self.q(statement, **parameters).take(most + 1)
        if len(rows) > most:
            raise ValueError(f"more than {most} rows; use q() and write them")
        return rows


def sql_function(name: str, *arguments: Column) -> Column:
    """One of the functions on columns, once a ``Sql`` has registered them."""
    return F.call_function(name, *arguments)
