"""SQL functions bound to names, usable from ``spark.sql`` scripts.

They are SQL-bodied temporary functions: the body is inlined into the plan as native
expressions, so no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillspark.functions.ip import IP_TO_LONG_SQL

FUNCTIONS = {
    "soft_threshold": "(x DOUBLE, l DOUBLE) RETURNS DOUBLE "
                      "RETURN signum(x) * greatest(abs(x) - l, 0D) + 0D",
    "relu": "(x DOUBLE) RETURNS DOUBLE RETURN greatest(x, 0D)",
    "ip_to_long": f"(ip STRING) RETURNS BIGINT RETURN {IP_TO_LONG_SQL}",
    "month_bucket": "(ts TIMESTAMP_NTZ) RETURNS STRING RETURN date_format(ts, 'yyyy-MM')",
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)
