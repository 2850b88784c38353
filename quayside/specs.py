"""Table specifications of the point-of-sale data model.

A ``TableSpec`` says where a raw table's files live, how they are read, and
which typed schema the text is converted to.  The catalog of specs is plain
data, so loading, saving and profiling loop over it rather than being written
once per table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# The raw point-of-sale schemas, folders and rename maps.
# These must equal the source pipelines' declarations for results to match;
# they are stated here as DDL in their declared column order.
# ---------------------------------------------------------------------------

ORDER_DETAIL_DDL = (
    "order_detail_id INT, order_id INT, menu_item_id INT, discount_id STRING, "
    "line_number INT, quantity INT, unit_price DOUBLE, price DOUBLE, "
    "order_item_discount_amount STRING"
)
ORDER_HEADER_DDL = (
    "order_id INT, truck_id INT, location_id FLOAT, customer_id INT, "
    "discount_id STRING, shift_id INT, shift_start_time STRING, "
    "shift_end_time STRING, order_channel STRING, order_ts TIMESTAMP_NTZ, "
    "served_ts STRING, order_currency STRING, order_amount DOUBLE, "
    "order_tax_amount STRING, order_discount_amount STRING, order_total DOUBLE"
)
TRUCK_DDL = (
    "truck_id INT, menu_type_id INT, primary_city STRING, region STRING, "
    "iso_region STRING, country STRING, iso_country_code STRING, "
    "franchise_flag INT, year INT, make STRING, model STRING, ev_flag INT, "
    "franchise_id INT, truck_opening_date DATE"
)
MENU_DDL = (
    "menu_id INT, menu_type_id INT, menu_type STRING, truck_brand_name STRING, "
    "menu_item_id INT, menu_item_name STRING, item_category STRING, "
    "item_subcategory STRING, cost_of_goods_usd DOUBLE, sale_price_usd DOUBLE, "
    "menu_item_health_metrics_obj STRING"
)
FRANCHISE_DDL = (
    "franchise_id INT, first_name STRING, last_name STRING, city STRING, "
    "country STRING, e_mail STRING, phone_number STRING"
)
LOCATION_DDL = (
    "location_id INT, placekey STRING, location STRING, city STRING, "
    "region STRING, iso_country_code STRING, country STRING"
)
CUSTOMER_LOYALTY_DDL = (
    "customer_id INT, first_name STRING, last_name STRING, city STRING, "
    "country STRING, postal_code STRING, preferred_language STRING, "
    "gender STRING, favourite_brand STRING, marital_status STRING, "
    "children_count INT, sign_up_date DATE, birthday_date DATE, "
    "e_mail STRING, phone_number STRING"
)
COUNTRY_DDL = (
    "country_id DECIMAL(18,0), country STRING, iso_currency STRING, "
    "iso_country STRING, city_id DECIMAL(19,0), city STRING, "
    "city_population STRING"
)

# Types that a raw table is declared with, where they differ from those of the scan:
# exact money, codes of a fixed length, whole numbers of stated digits, times, JSON.
DECLARED_TYPES = {
    "country": {
        "country_id": "DECIMAL(18,0)", "iso_currency": "VARCHAR(3)", "iso_country": "VARCHAR(2)",
        "city_id": "DECIMAL(19,0)",
    },
    "franchise": {"franchise_id": "DECIMAL(38,0)"},
    "location": {"location_id": "DECIMAL(19,0)"},
    "menu": {
        "menu_id": "DECIMAL(19,0)", "menu_type_id": "DECIMAL(38,0)",
        "menu_item_id": "DECIMAL(38,0)", "cost_of_goods_usd": "DECIMAL(38,4)",
        "sale_price_usd": "DECIMAL(38,4)", "menu_item_health_metrics_obj": "VARIANT",
    },
    "truck": {
        "truck_id": "DECIMAL(38,0)", "menu_type_id": "DECIMAL(38,0)",
        "franchise_flag": "DECIMAL(38,0)", "year": "DECIMAL(38,0)", "ev_flag": "DECIMAL(38,0)",
        "franchise_id": "DECIMAL(38,0)",
    },
    "order_header": {
        "order_id": "DECIMAL(38,0)", "truck_id": "DECIMAL(38,0)", "location_id": "DOUBLE",
        "customer_id": "DECIMAL(38,0)", "shift_id": "DECIMAL(38,0)",
        "order_currency": "VARCHAR(3)", "order_amount": "DECIMAL(38,4)",
        "order_total": "DECIMAL(38,4)",
    },
    "order_detail": {
        "order_detail_id": "DECIMAL(38,0)", "order_id": "DECIMAL(38,0)",
        "menu_item_id": "DECIMAL(38,0)", "line_number": "DECIMAL(38,0)",
        "quantity": "DECIMAL(5,0)", "unit_price": "DECIMAL(38,4)", "price": "DECIMAL(38,4)",
    },
    "customer_loyalty": {"customer_id": "DECIMAL(38,0)", "children_count": "STRING"},
}

# Table name -> folder below the stage root.
RAW_FOLDERS = {
    "order_detail": "raw_pos/order_detail/",
    "order_header": "raw_pos/order_header/",
    "truck": "raw_pos/truck/",
    "menu": "raw_pos/menu/",
    "franchise": "raw_pos/franchise/",
    "location": "raw_pos/location/",
    "customer_loyalty": "raw_customer/customer_loyalty/",
    "country": "raw_pos/country/",
}

# Colliding column names are prefixed with their table before the wide join.
PREFIX_RENAMES = {
    "order_detail": {"discount_id": "order_detail_discount_id"},
    "order_header": {"discount_id": "order_header_discount_id"},
    "truck": {
        "city": "truck_city",
        "country": "truck_country",
        "region": "truck_region",
        "menu_type_id": "truck_menu_type_id",
        "iso_country_code": "truck_iso_country_code",
    },
    "menu": {"menu_type_id": "menu_menu_type_id"},
    "franchise": {
        "city": "franchise_city",
        "country": "franchise_country",
        "region": "franchise_region",
        "first_name": "franchise_first_name",
        "last_name": "franchise_last_name",
        "e_mail": "franchise_email",
        "phone_number": "franchise_phone_number",
    },
    "location": {
        "city": "location_city",
        "country": "location_country",
        "region": "location_region",
        "iso_country_code": "location_iso_country_code",
    },
    "customer_loyalty": {
        "city": "customer_city",
        "country": "customer_country",
        "region": "customer_region",
        "first_name": "customer_first_name",
        "last_name": "customer_last_name",
        "e_mail": "customer_email",
        "phone_number": "customer_phone_number",
    },
}

# Layer namespaces of the warehouse.
NAMESPACES = ("raw_pos", "raw_customer", "harmonized", "analytics")

# Tables the wide join cannot do without.  Customers are included: the join
# uses them unconditionally, so their absence must stop the plan up front.
REQUIRED_FOR_JOIN = (
    "order_detail",
    "order_header",
    "truck",
    "menu",
    "franchise",
    "location",
    "customer_loyalty",
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """How one raw table is read and where it is written.

    ``schema`` is a DDL string or None (every column string).  ``header``
    says whether the first line of every file is a header
    ("auto": each file decides); a declared schema
    is matched to the fields by position either way.  ``options`` are extra
    CSV reader options (``escape`` for JSON-in-CSV, ``compression`` ...).
    """

    name: str
    folder: str
    schema: str | None = None
    header: bool | str = True
    namespace: str = "raw_pos"
    options: dict = field(default_factory=dict)
    bucket_key: str | None = None

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.folder.lstrip('/')}"


def ddl_columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of the columns of a flat DDL, without a session."""
    return re.findall(r"`?(\w+)`? (\w+(?:\([\d, ]+\))?)", ddl)


def pos_catalog(header: bool = True) -> dict[str, TableSpec]:
    """The eight raw point-of-sale tables with their declared schemas."""
    ddl = {
        "order_detail": ORDER_DETAIL_DDL,
        "order_header": ORDER_HEADER_DDL,
        "truck": TRUCK_DDL,
        "menu": MENU_DDL,
        "franchise": FRANCHISE_DDL,
        "location": LOCATION_DDL,
        "customer_loyalty": CUSTOMER_LOYALTY_DDL,
        "country": COUNTRY_DDL,
    }
    out = {}
    for name, folder in RAW_FOLDERS.items():
        opts = {}
        if name == "menu":
            # The health-metrics column holds JSON with doubled quotes.
            opts["escape"] = '"'
        out[name] = TableSpec(
            name=name,
            folder=folder,
            schema=ddl[name],
            header=header,
            namespace="raw_customer" if name == "customer_loyalty" else "raw_pos",
            options=opts,
            # The two big tables share the order key; bucketing both on it
            # lets the header/detail join run without a shuffle.
            bucket_key="order_id" if name in ("order_detail", "order_header") else None,
        )
    return out
