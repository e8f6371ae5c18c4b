"""The contract of an online-shop catalogue: twelve tables, their targets, rules and keys."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    TimestampNTZType,
)

from tablemend.contract import CASCADE, DO_NOTHING, SET_NULL, Catalog, TableSpec, column, table
from tablemend.operators.dedup import DedupRule
from tablemend.plans.clean import ReduceRule

INT, TINY, TEXT, FLAG = IntegerType(), ByteType(), StringType(), BooleanType()
DAY, TIME = DateType(), TimestampNTZType()
PRICE, MEASURE = DecimalType(15, 4), DecimalType(15, 8)


def _key(name: str):
    return column(name, INT, key=True)


def _texts(*names: str, nullable: bool = True):
    return [column(n, TEXT, nullable=nullable) for n in names]


def _flag(name: str, default: bool | None = None):
    return column(name, FLAG, rule="int_to_bool", default=default)


def _time(name: str):
    return column(name, TIME, rule="normalize_date")


def _measure(name: str):
    return column(name, MEASURE, default="0.00000000")


def _short(name: str, length: int, default: str | None = None):
    return column(name, TEXT, max_length=length, default=default)


# Table, column and target names, types, limits, rules and key policies.


def _product() -> TableSpec:
    return table(
        "oc_product",
        [
            _key("product_id"),
            _short("model", 64),
            _short("sku", 64, ""),
            _short("upc", 12, ""),
            _short("ean", 14, ""),
            _short("jan", 13, ""),
            column("isbn", TEXT, rule="value_to_none", args={"gauge": "Не маркируется"}, max_length=64),
            _short("mpn", 64, ""),
            _short("location", 128, ""),
            column("quantity", INT, default=0),
            column("stock_status_id", INT, references="oc_stock_status", on_delete=DO_NOTHING),
            _short("image", 255),
            column("manufacturer_id", INT, rule="zero_to_none", references="oc_manufacturer", on_delete=SET_NULL),
            _flag("shipping", True),
            column("price", PRICE, default="0.0000"),
            column("points", INT, default=0),
            column("tax_class_id", INT, references="oc_tax_class", on_delete=SET_NULL),
            column("date_available", DAY, rule="value_to_none", args={"gauge": "0000-00-00"}),
            _measure("weight"),
            column("weight_class_id", INT, rule="zero_to_none", references="oc_weight_class", on_delete=DO_NOTHING),
            _measure("length"),
            _measure("width"),
            _measure("height"),
            column("length_class_id", INT, rule="zero_to_none", references="oc_length_class", on_delete=DO_NOTHING),
            _flag("subtract", True),
            column("minimum", INT, default=1),
            column("sort_order", INT, default=0),
            _flag("status", True),
            column("viewed", INT, default=0),
            _time("date_added"),
            _time("date_modified"),
            _flag("yandexmerchants", False),
        ],
        target="catalog_product",
    )


def _product_description() -> TableSpec:
    return table(
        "oc_product_description",
        [
            _key("product_id"),
            *_texts("name"),
            column("description", TEXT, rule="to_html"),
            *_texts("tag", "meta_title", "meta_description", "meta_keyword"),
        ],
        target="catalog_product_description",
    )


def _review() -> TableSpec:
    return table(
        "oc_review",
        [
            _key("review_id"),
            column("product_id", INT, references="oc_product", on_delete=CASCADE),
            _short("author", 64),
            column("text", TEXT),
            column("rating", INT, min_value=1, max_value=5),
            _flag("status", False),
            _time("date_added"),
            _time("date_modified"),
        ],
        target="catalog_review",
    )


def _category() -> TableSpec:
    return table(
        "oc_category",
        [
            _key("category_id"),
            column("image", TEXT, asset=True),
            *_texts("sbmenu_icon", "sbmenu_image"),
            column("parent_id", INT, rule="zero_to_none"),
            column("top", TINY, nullable=False),
            column("column", INT, nullable=False),
            column("sort_order", INT, nullable=False),
            column("status", TINY, nullable=False),
            column("date_added", TIME, nullable=False),
            column("date_modified", TIME, nullable=False),
            *_texts("code", "sbmenu_content"),
        ],
        target="catalog_category",
    )


def _category_description() -> TableSpec:
    return table(
        "oc_category_description",
        [
            _key("category_id"),
            column("language_id", INT, nullable=False),
            *_texts("name", nullable=False),
            *_texts("description"),
            *_texts("meta_title", nullable=False),
            *_texts("meta_description", "meta_keyword"),
        ],
        target="catalog_categorydescription",
    )


def _lookup_tables() -> dict[str, TableSpec]:
    specs = [
        table("oc_stock_status", [_key("stock_status_id"), _short("name", 32)], target="catalog_stockstatus"),
        table(
            "oc_tax_class",
            [
                _key("tax_class_id"),
                _short("title", 32),
                _short("description", 255),
                _time("date_added"),
                _time("date_modified"),
            ],
            target="catalog_taxclass",
        ),
        table(
            "oc_manufacturer",
            [
                _key("manufacturer_id"),
                _short("name", 64),
                _short("image", 255),
                column("sort_order", INT, default=0),
            ],
            target="catalog_manufacturer",
        ),
        table("oc_weight_class", [_key("weight_class_id"), _measure("value")], target="catalog_weightclass"),
        table("oc_length_class", [_key("length_class_id"), _measure("value")], target="catalog_lengthclass"),
        table(
            "oc_category_path",
            [column(n, INT, nullable=False) for n in ("category_id", "path_id", "level")],
            target="catalog_categorypath",
        ),
        table(
            "oc_product_to_category",
            [
                column("product_id", INT, nullable=False),
                column("category_id", INT, nullable=False),
                _flag("main_category"),
            ],
            target="catalog_producttocategory",
        ),
    ]
    return {s.name: s for s in specs}


def shop_catalog(single_language: bool = False, language_id: int | None = None) -> Catalog:
    """The twelve tables.

    With ``single_language`` the description tables lose their language column
    and are folded into the tables they describe. Dropping the column does not
    choose a language: give ``language_id`` to read the rows of one only.
    """
    product_description, category_description = _product_description(), _category_description()
    if single_language:
        product_description = product_description.without("language_id").folded_into("oc_product")
        category_description = category_description.without("language_id").folded_into("oc_category")
    lookups = _lookup_tables()
    catalog = Catalog(
        [
            product_description,
            lookups["oc_stock_status"],
            lookups["oc_tax_class"],
            lookups["oc_manufacturer"],
            lookups["oc_weight_class"],
            lookups["oc_length_class"],
            _product(),
            _review(),
            _category(),
            lookups["oc_category_path"],
            category_description,
            lookups["oc_product_to_category"],
        ]
    )
    if language_id is not None:
        names = ("oc_product_description", "oc_category_description", "oc_stock_status")
        catalog = catalog.with_specs(
            *[replace(catalog[n], row_filter=f"language_id = {int(language_id)}") for n in names]
        )
    return catalog


SHOP_DEDUP_RULES = {
    "oc_review": DedupRule(("text",)),
}

SHOP_REDUCE_RULES = {
    "oc_product_to_category": ReduceRule("oc_category", "product_id", "category_id", "category_id", "parent_id"),
}
