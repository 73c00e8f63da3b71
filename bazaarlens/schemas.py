"""Table schemas and keys. Timestamps are wall-clock, without time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

MONEY = "decimal(18,7)"

TABLES = {
    "products": f"barcode string, model_code string, name string, category string, brand string, color string, "
                f"size string, current_price {MONEY}, current_stock int",
    "sales_monthly": f"period date, barcode string, gross_order_qty int, gross_sales_qty int, cancel_qty int, "
                     f"return_qty int, net_sales_qty int, gross_revenue {MONEY}, discount {MONEY}, net_revenue {MONEY}, "
                     f"commission {MONEY}, commission_rate {MONEY}, avg_price {MONEY}, stock int, reasons string",
    "orders": f"package_no string, order_no string, order_at timestamp_ntz, deadline_at timestamp_ntz, "
              f"shipped_at timestamp_ntz, delivered_at timestamp_ntz, carrier string, status string, city string, "
              f"district string, customer string, customer_nth string, age_band string, gender string, gross {MONEY}, "
              f"discount {MONEY}, ty_discount {MONEY}, net {MONEY}, cargo_fee {MONEY}, desi {MONEY}, commission decimal(18,9), "
              f"fast_delivery string",
    "order_lines": f"package_no string, barcode string, qty bigint, unit_price {MONEY}, gross {MONEY}, discount {MONEY}, "
                   f"ty_discount {MONEY}, net {MONEY}, commission_rate {MONEY}",
    "distribution": "period date, dimension string, bucket string, bucket2 string, orders int, customers int",
    "store_daily": "day date, store_views double, followers_total double, followers_gained double, followers_lost double, "
                   "visitors double, new_visitors double, follow_rate double, customer_rate double, store_orders double, "
                   "total_orders double, store_units double, total_units double, store_conversion double, "
                   "store_revenue double, total_revenue double, store_customers double, total_customers double",
    "ops_monthly": "period date, metric string, value double",
    "ad_campaigns": f"name string, status string, started_at timestamp_ntz, product_count int, product_ids string, "
                    f"total_budget {MONEY}, daily_budget {MONEY}, spent {MONEY}, cpc {MONEY}, clicks bigint, impressions bigint, "
                    f"direct_sales bigint, indirect_sales bigint, direct_revenue {MONEY}, indirect_revenue {MONEY}, roas {MONEY}",
    "ad_totals": f"period_from date, period_to date, source string, impressions bigint, clicks bigint, sales bigint, "
                 f"revenue {MONEY}, spend {MONEY}, roas {MONEY}",
    "uploads": "file_name string, report_type string, period string, row_count bigint, uploaded_at timestamp_ntz",
}

KEYS = {
    "products": ["barcode"],
    "sales_monthly": ["period", "barcode"],
    "orders": ["package_no"],
    "order_lines": ["package_no", "barcode"],
    "distribution": ["period", "dimension", "bucket", "bucket2"],
    "store_daily": ["day"],
    "ops_monthly": ["period", "metric"],
    "ad_campaigns": ["name"],
    "ad_totals": ["period_from", "period_to", "source"],
}

# Write order that satisfies the references between tables.
LOAD_ORDER = ["products", "sales_monthly", "orders", "order_lines", "distribution", "store_daily", "ops_monthly",
              "ad_campaigns", "ad_totals"]

STORE_MEASURES = [field.split()[0] for field in TABLES["store_daily"].split(",")[1:]]


def table_schema(name: str) -> StructType:
    """Spark schema of a table; needs a running session."""
    return StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """`df` with exactly the declared columns and types of table `name`, and the columns of `keep`; columns it lacks are null."""
    have = set(df.columns)
    cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table_schema(name).fields]
    return df.select(*cols, *[F.col(f"`{c}`") for c in keep or []])
