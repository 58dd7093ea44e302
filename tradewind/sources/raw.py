"""The nine raw tables: declared schemas, readers and staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.lazy import Frames

# Raw table -> columns, with the source's own spelling.
RAW_SCHEMAS = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price double, freight_value double""",
    "payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "reviews": """review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz,
        review_answer_timestamp timestamp_ntz""",
    "customers": """customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    "sellers": """seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string""",
    "products": """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g int,
        product_length_cm int, product_height_cm int, product_width_cm int""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double,
        geolocation_lng double, geolocation_city string, geolocation_state string""",
    "category_translation": "product_category_name string, product_category_name_english string",
}

CORRUPT = "_corrupt"  # the text of a row that doesn't fit the declared columns

# Tables whose texts may span lines.
MULTILINE = ("reviews",)

# Raw name -> staging name, where they differ.
STAGING_NAMES = {"payments": "order_payments", "reviews": "order_reviews"}


def _sound(columns: list[str]) -> Column:
    """True, or an error for a malformed row. It reads every column: those that a query leaves out are parsed as well."""
    message = F.concat(F.lit("malformed row: "), F.col(CORRUPT), F.lit(" "), F.xxhash64(*columns).cast("string"))
    return F.when(F.col(CORRUPT).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))


def read_csv_folder(spark: SparkSession, folder: str, **options) -> Frames:
    """Raw tables from ``folder/<table>.csv``, each a file or a folder of parts with headers.

    Headers are checked against the declared schema; nothing is scanned to infer types. A value of the
    wrong type or a row of the wrong length stops the load, in whatever columns are read: rows are always
    parsed whole. ``mode="PERMISSIVE"`` turns it into NULLs; ``csv_load.CsvLoad`` keeps such rows apart instead.
    Free text may span lines, so quoted line breaks are honoured by default for the
    reviews table only, as they stop this reader from splitting a file (``CsvLoad`` splits it all the same).
    """

    def read(table: str) -> DataFrame:
        settings = {
            "header": True,
            "enforceSchema": False,
            "escape": '"',
            "mode": "PERMISSIVE",
            "columnPruning": False,
            "columnNameOfCorruptRecord": CORRUPT,
            "multiLine": table in MULTILINE,
            **options,
        }
        rows = spark.read.schema(f"{RAW_SCHEMAS[table]}, {CORRUPT} string").options(**settings).csv(f"{folder}/{table}.csv")
        return (rows if "mode" in options else rows.filter(_sound(rows.columns))).drop(CORRUPT)

    return Frames({table: (lambda t=table: read(t)) for table in RAW_SCHEMAS})


def read_parquet_folder(spark: SparkSession, folder: str) -> Frames:
    return Frames(
        {t: (lambda t=t: spark.read.parquet(f"{folder}/{t}.parquet")) for t in RAW_SCHEMAS}
    )


def read_database(spark: SparkSession, database: str) -> Frames:
    return Frames({t: (lambda t=t: spark.table(f"`{database}`.`{t}`")) for t in RAW_SCHEMAS})


def stage(raw: Mapping[str, DataFrame], views: bool = False) -> Frames:
    """Raw tables, unmodified, under their staging names; optionally as temporary views."""
    staged = Frames({STAGING_NAMES.get(name, name): (lambda n=name: raw[n]) for name in raw})
    if views:
        for name, df in staged.items():
            df.createOrReplaceTempView(f"staging_{name}")
    return staged
