import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tablemend import (
    CASCADE,
    DO_NOTHING,
    SET_NULL,
    Catalog,
    ContractError,
    ForeignKey,
    JoinInto,
    UnknownTableError,
    column,
    table,
)

INT, TEXT = IntegerType(), StringType()


def _catalog():
    return Catalog(
        [
            table(
                "review",
                [column("id", INT, key=True), column("product", INT, references="product", on_delete=CASCADE)],
                "t_review",
            ),
            table(
                "product",
                [
                    column("id", INT, key=True),
                    column("maker", INT, references="maker", on_delete=SET_NULL),
                    column("image", TEXT, asset=True),
                    column("other", INT, references="maker"),
                ],
                "t_product",
            ),
            table("maker", [column("id", INT, key=True)], "t_maker"),
            table("text", [column("id", INT, key=True), column("t", TEXT)], "t_text", JoinInto("product")),
        ]
    )


def test_facts_from_metadata():
    catalog = _catalog()
    assert catalog["review"].foreign_keys == (ForeignKey("product", "product", CASCADE),)
    assert catalog["product"].foreign_keys[1] == ForeignKey("other", "maker", DO_NOTHING)
    assert catalog["product"].primary_key == ("id",)
    assert catalog.join_map() == {"product": ["text"]}
    assert catalog.asset_map() == {"product": ("image",)}
    assert catalog.target_names()["maker"] == "t_maker"
    catalog.validate()


def test_load_order_follows_references():
    order = _catalog().load_order()
    assert order.index("maker") < order.index("product") < order.index("review")
    assert _catalog().load_order(["review", "maker"]) == ["review", "maker"]


def test_load_order_reports_a_cycle_and_allows_self_reference():
    a = table("a", [column("id", INT, key=True), column("b", INT, references="b")], "a")
    b = table("b", [column("id", INT, key=True), column("a", INT, references="a")], "b")
    with pytest.raises(ContractError, match="cycle"):
        Catalog([a, b]).load_order()
    tree = table("tree", [column("id", INT, key=True), column("up", INT, references="tree")], "tree")
    assert Catalog([tree]).load_order() == ["tree"]


def test_unknown_table():
    with pytest.raises(UnknownTableError, match="'nothing' is not declared"):
        _catalog()["nothing"]
    with pytest.raises(UnknownTableError):
        _catalog().subset(["nothing"])


def test_subset_keeps_catalog_order():
    assert _catalog().subset(["maker", "review"]) == ["review", "maker"]
    assert _catalog().subset() == ["review", "product", "maker", "text"]


def test_validate_needs_target_and_declared_references():
    with pytest.raises(ContractError, match="no target name"):
        Catalog([table("a", [column("id", INT, key=True)])]).validate()
    with pytest.raises(UnknownTableError):
        Catalog([table("a", [column("b", INT, references="b")], "a")]).validate()
    with pytest.raises(ContractError, match="declared twice"):
        table("a", [column("x", INT), column("x", INT)], "a").validate()


def test_check_schema():
    spec = table("a", [column("id", INT, key=True), column("t", TEXT)], "a")
    with pytest.raises(ContractError, match="missing columns"):
        spec.check(StructType([StructField("id", INT)]))
    wrong = StructType([StructField("id", LongType()), StructField("t", TEXT)])
    with pytest.raises(ContractError, match="id is bigint, declared int"):
        spec.check(wrong)
    spec.check(wrong, types=False)


def test_without_ignores_unknown_columns():
    spec = _catalog()["text"].without("t", "language")
    assert spec.columns == ["id"]
    assert spec.target_name == "t_text"


def test_key_column_must_be_single():
    with pytest.raises(ContractError, match="single-column"):
        table("a", [column("x", INT), column("y", INT)], "a").key_column
