"""The extracts as functions that SQL text can call: ``SELECT * FROM getChecks(TIMESTAMP_NTZ '2016-01-01', TIMESTAMP_NTZ '2018-01-01')``.

They are Spark's own SQL functions, so the optimiser inlines them: filters and column pruning reach the tables as if the query were
written out. Names and parameters are those that users of such warehouses call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillhouse.schemas import CARD_EXTRACT, CHECK_EXTRACT, PRODUCT_EXTRACT

WINDOW = "startDate TIMESTAMP_NTZ, endDate TIMESTAMP_NTZ"


def _table(schema) -> str:
    return f"TABLE ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)})"


# name: (parameters, what it returns, body over the views retail_*)
FUNCTIONS = {
    "getNewProducts": (WINDOW, _table(PRODUCT_EXTRACT), """
        SELECT r.price_id, r.cost, r.cost_sale, r.set_date, p.product_id, p.name, p.vendor_code, s.supplier_id, s.name, s.inn
        FROM retail_product p JOIN retail_price r ON r.product_id = p.product_id JOIN retail_supplier s ON s.supplier_id = p.supplier_id
        WHERE p.created_at BETWEEN startDate AND endDate"""),
    "getNewCards": (WINDOW, _table(CARD_EXTRACT), """
        SELECT card_id, number, first_name, middle_name, last_name, birth_date FROM retail_card
        WHERE modified_at BETWEEN startDate AND endDate"""),
    "getChecks": (WINDOW, _table(CHECK_EXTRACT), """
        SELECT c.check_id, c.card_id, c.check_date, c.payed, c.payment_form, l.price, l.cnt, l.product_id, p.supplier_id
        FROM retail_check c JOIN retail_line l ON l.check_id = c.check_id JOIN retail_product p ON p.product_id = l.product_id
        WHERE c.check_date BETWEEN startDate AND endDate"""),
    "getChecksOfCard": ("wanted BIGINT", "TABLE (check_id BIGINT, check_date TIMESTAMP_NTZ)",
                        "SELECT check_id, check_date FROM retail_check WHERE card_id = wanted"),
    "CoverInQuotes": ("source_value STRING", "STRING",
                      "CASE WHEN source_value IS NULL THEN 'NULL' ELSE concat('\\'', replace(source_value, '\\'', '\\'\\''), '\\'') END"),
}


def install(spark: SparkSession, **tables: DataFrame) -> None:
    """Make the functions callable in this session, over these tables (card, check, line, price, product, supplier)."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(f"retail_{name}")
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
