"""One query per operator, over the whole of the given tables.

The given tables hold no orphans, zero dates or blanks, so a query makes some
with an expression over all rows before it calls the operator. A key is taken away
from its referrers by another value, ``-1 - key``; its row stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
)

from tablemend import CASCADE, DO_NOTHING, SET_NULL, Catalog, JoinInto, column, table
from tablemend.functions import below, register_rule
from tablemend.operators import (
    DedupRule,
    Target,
    ancestors,
    broken_keys,
    declared_columns,
    deduplicate,
    distinct_texts,
    distinct_values,
    enforce,
    fill_defaults,
    left_join,
    list_files,
    manifest,
    mark_key,
    normalize,
    normalize_lenient,
    orphan_counts,
    orphans,
    profile,
    project_all,
    project_to_target,
    publish,
    publish_counts,
    reduce_to_deepest,
    reduce_to_deepest_of_all,
    rejects,
    repeated_keys,
    rows_with_keys,
    sweep,
    violations,
    with_listed_presence,
    with_presence,
)
from tablemend.plans import ReduceRule, StageStore, clean, shared_folder
from tablemend.sources import read_csv, read_table, read_tables, write_csv, write_quarantine, write_table

LONG, INT, TEXT, TIME = LongType(), IntegerType(), StringType(), TimestampNTZType()


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/run-{uuid4().hex}"


# --- foreign keys -----------------------------------------------------------

ORDER_COLUMNS = [
    ("o_orderkey", LONG),
    ("o_custkey", LONG),
    ("o_orderstatus", TEXT),
    ("o_totalprice", DecimalType(15, 2)),
    ("o_orderdate", TIME),
    ("o_orderpriority", TEXT),
]


def _orders_referring(policy: str):
    return table(
        "orders",
        [
            column("o_orderkey", LONG, key=True),
            column("o_custkey", LONG, references="customer", on_delete=policy),
        ],
        target="orders",
    )


def _moved(df: DataFrame, key: str, stays: str) -> DataFrame:
    """All rows, with another key where ``stays`` does not hold."""
    return df.withColumn(key, F.expr(f"CAST(CASE WHEN {stays} THEN {key} ELSE -1 - {key} END AS {df.schema[key].dataType.simpleString()})"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved(_read(spark, sf_dir, "customer"), "c_custkey", "c_acctbal > 0")


def _live_customers(spark: SparkSession, sf_dir: str) -> Target:
    return Target(_customers(spark, sf_dir), "c_custkey")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(_read(spark, sf_dir, "orders"), "o_custkey", _live_customers(spark, sf_dir))


def _checked_orders(spark: SparkSession, sf_dir: str, policy: str):
    targets = {"customer": _live_customers(spark, sf_dir)}
    return enforce(_read(spark, sf_dir, "orders"), _orders_referring(policy), targets)


def fk_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_orders(spark, sf_dir, CASCADE).clean


def fk_set_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_orders(spark, sf_dir, SET_NULL).clean


def fk_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_orders(spark, sf_dir, DO_NOTHING).clean


def fk_do_nothing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_orders(spark, sf_dir, DO_NOTHING).quarantine


def fk_zero_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = {"customer": _live_customers(spark, sf_dir)}
    return enforce(
        _read(spark, sf_dir, "orders"), _orders_referring(SET_NULL), targets, zero_as_null=True
    ).clean


def fk_broken_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_keys(_read(spark, sf_dir, "orders"), "o_custkey", _live_customers(spark, sf_dir))


LINE_CATALOG = Catalog(
    [
        table("part", [column("p_partkey", LONG, key=True)], target="part"),
        table("supplier", [column("s_suppkey", LONG, key=True)], target="supplier"),
        table(
            "lineitem",
            [
                column("l_orderkey", LONG),
                column("l_partkey", LONG, references="part", on_delete=CASCADE),
                column("l_suppkey", LONG, references="supplier", on_delete=SET_NULL),
            ],
            target="lineitem",
        ),
    ]
)


def _line_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "part": _moved(_read(spark, sf_dir, "part"), "p_partkey", "p_size <= 40"),
        "supplier": _moved(_read(spark, sf_dir, "supplier"), "s_suppkey", "s_acctbal > 0"),
        "lineitem": _read(spark, sf_dir, "lineitem"),
    }


def fk_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = sweep(LINE_CATALOG, _line_tables(spark, sf_dir))
    return tables["lineitem"]


def fk_sweep_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = sweep(LINE_CATALOG, _line_tables(spark, sf_dir), work_dir=_scratch(spark))
    return tables["lineitem"]


def fk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = sweep(LINE_CATALOG, _line_tables(spark, sf_dir))
    return quarantine["lineitem"]


def fk_orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = sweep(LINE_CATALOG, _line_tables(spark, sf_dir))
    return orphan_counts(quarantine)


ORDER_LINE_CATALOG = Catalog(
    [
        table("customer", [column("c_custkey", LONG, key=True)], target="customer"),
        table(
            "orders",
            [
                column("o_orderkey", LONG, key=True),
                column("o_custkey", LONG, references="customer", on_delete=CASCADE),
            ],
            target="orders",
        ),
        table(
            "lineitem",
            [column("l_orderkey", LONG, references="orders", on_delete=CASCADE)],
            target="lineitem",
        ),
    ]
)


def fk_cascade_transitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "customer": _customers(spark, sf_dir),
        "orders": _read(spark, sf_dir, "orders"),
        "lineitem": _read(spark, sf_dir, "lineitem"),
    }
    cleaned, _ = sweep(ORDER_LINE_CATALOG, tables, transitive=True)
    return cleaned["lineitem"]


CYCLE_CATALOG = Catalog(
    [
        table(
            "customer",
            [column("c_custkey", LONG, key=True), column("c_orderkey", LONG, references="orders", on_delete=CASCADE)],
            target="customer",
        ),
        table(
            "orders",
            [
                column("o_orderkey", LONG, key=True),
                column("o_custkey", LONG, references="customer", on_delete=CASCADE),
            ],
            target="orders",
        ),
    ]
)


def _cyclic_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders refer to customers, and a third of the customers to an order."""
    order = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") * 10).alias("c_orderkey")
    return {
        "customer": _moved(_read(spark, sf_dir, "customer").select("*", order), "c_custkey", "c_acctbal > 0"),
        "orders": _read(spark, sf_dir, "orders"),
    }


def fk_cascade_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = sweep(CYCLE_CATALOG, _cyclic_tables(spark, sf_dir), transitive=True, work_dir=_scratch(spark))
    return cleaned["orders"]


def fk_cascade_cycle_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = sweep(CYCLE_CATALOG, _cyclic_tables(spark, sf_dir), transitive=True, work_dir=_scratch(spark))
    return quarantine["customer"].select("c_custkey", "c_orderkey", "_fk", "_target")


def key_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _read(spark, sf_dir, "customer").select((F.col("c_custkey") * 7).alias("k"))
    return rows_with_keys(_read(spark, sf_dir, "orders"), "o_orderkey", keys, "k")


def key_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_key(
        _read(spark, sf_dir, "documents").select("doc_id"), "doc_id", _read(spark, sf_dir, "labels"), "doc_id", "found"
    )
    return marked


# --- value rules ------------------------------------------------------------


def zero_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "lineitem",
        [column("l_orderkey", LONG), column("l_suppkey", LONG, rule="zero_to_none"), column("l_linenumber", INT)],
        target="lineitem",
    )
    return normalize(_read(spark, sf_dir, "lineitem"), spec)


def value_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "events",
        [
            column("event_id", LONG, key=True),
            column("event_type", TEXT, rule="value_to_none", args={"gauge": "error"}),
        ],
        target="events",
    )
    return normalize(_read(spark, sf_dir, "events"), spec)


def _orders_with_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_orderdate").cast("string")
    zero = F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00 00:00:00")).otherwise(text)
    return _read(spark, sf_dir, "orders").withColumn("o_orderdate", zero)


def zero_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "orders",
        [column("o_orderkey", LONG, key=True), column("o_orderdate", TIME, rule="normalize_date")],
        target="orders",
    )
    return normalize(_orders_with_text_dates(spark, sf_dir), spec)


def int_to_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "labels",
        [
            column("doc_id", LONG, key=True),
            column("quality", BooleanType(), rule="int_to_bool"),
            column("toxic", BooleanType(), rule="int_to_bool"),
        ],
        target="labels",
    )
    raw = _read(spark, sf_dir, "labels").withColumn("toxic", F.nullif("toxic", F.lit(0)))
    return normalize(raw, spec)


def html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "pages",
        [column("page_id", LONG, key=True), column("html", TEXT, rule="to_html")],
        target="pages",
    )
    return normalize(_read(spark, sf_dir, "pages"), spec)


NORMALIZED_ORDERS = table(
    "orders",
    [
        column("o_orderkey", LONG, key=True),
        column("o_custkey", INT, rule="zero_to_none"),
        column("o_orderstatus", TEXT, rule="value_to_none", args={"gauge": "P"}),
        column("o_totalprice", DecimalType(15, 2)),
        column("o_orderdate", TIME, rule="normalize_date"),
    ],
    target="orders",
)


def normalize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_orders_with_text_dates(spark, sf_dir), NORMALIZED_ORDERS)


PRIORITY_NUMBER = table(
    "orders",
    [column("o_orderkey", LONG, key=True), column("o_orderpriority", INT)],
    target="orders",
)


def _orders_with_priority_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # "5-LOW" is no number; the text of a customer's key is.
    number = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("string"))
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(number, F.col("o_orderpriority")).alias("o_orderpriority")
    )


def user_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of the caller's own, attached to a column by name."""
    register_rule("first_word", lambda value, data_type, mark: F.substring_index(value, mark, 1))
    spec = table(
        "orders",
        [column("o_orderkey", LONG, key=True), column("o_orderpriority", TEXT, rule="first_word", args={"mark": "-"})],
        target="orders",
    )
    return normalize(_read(spark, sf_dir, "orders"), spec)


def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition that a contract puts on the rows of its table."""
    catalog = Catalog([replace(CUSTOMER, row_filter="c_acctbal > 0")])
    return read_tables(spark, catalog, sf_dir)["customer"]


def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_lenient(_orders_with_priority_text(spark, sf_dir), PRIORITY_NUMBER)


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_orders_with_priority_text(spark, sf_dir), PRIORITY_NUMBER)


# --- duplicates -------------------------------------------------------------


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(_read(spark, sf_dir, "documents"), ["text"], "first", ["doc_id"], _scratch(spark))


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(_read(spark, sf_dir, "documents"), ["text"], "last", ["doc_id"], _scratch(spark))


def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which row of a group stays is free; the length goes by the text, so it is the same in all of them.
    kept = deduplicate(_read(spark, sf_dir, "documents"), ["text", "lang"], "any", work_dir=_scratch(spark))
    return kept.select("text", "lang", "n_chars")


def dedup_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(_read(spark, sf_dir, "documents"), ["text"], "none")


def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax"]
    return deduplicate(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "first", order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


def distinct_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.when(F.col("p_size") > 5, F.col("p_brand"))
    return distinct_values(_read(spark, sf_dir, "part").withColumn("p_brand", brand), "p_brand")


# --- joins and projections --------------------------------------------------


def left_join_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_join(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "doc_id")


def left_join_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dependent whose key repeats: customers with their orders, if any."""
    orders = _read(spark, sf_dir, "orders")
    return left_join(_customers(spark, sf_dir), orders, "c_custkey", "o_custkey", unique_key=False)


def _joined_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer")
    with_nation = left_join(customers, _read(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey")
    return left_join(with_nation, _read(spark, sf_dir, "region"), "n_regionkey", "r_regionkey")


def left_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_customers(spark, sf_dir)


CUSTOMER = table(
    "customer",
    [
        column("c_custkey", LONG, key=True),
        column("c_name", TEXT),
        column("c_nationkey", INT),
        column("c_mktsegment", TEXT),
    ],
    target="customer",
)
NATION = table(
    "nation",
    [column("n_nationkey", INT, key=True), column("n_name", TEXT), column("n_regionkey", INT)],
    target="nation",
)
REGION = table("region", [column("r_regionkey", INT, key=True), column("r_name", TEXT)], target="region")


def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_to_target(_joined_customers(spark, sf_dir), CUSTOMER, [NATION, REGION])


def declared_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared_columns(_read(spark, sf_dir, "customer"), CUSTOMER.without("c_mktsegment", "no_such_column"))


# --- hierarchy --------------------------------------------------------------


def _order_places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders linked to places, and the tree of places: a nation below 1000 + its region."""
    nation = _read(spark, sf_dir, "nation")
    tree = nation.select(F.col("n_nationkey").alias("place"), (F.col("n_regionkey") + 1000).alias("parent"))
    supplied = (
        _read(spark, sf_dir, "lineitem")
        .join(_read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("l_orderkey").alias("orderkey"), F.col("s_nationkey").alias("place"))
        .distinct()
    )
    sold = (
        _read(spark, sf_dir, "orders")
        .join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderkey").alias("orderkey"), (F.col("n_regionkey") + 1000).alias("place"))
    )
    return supplied.unionByName(sold), tree


def reduce_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, tree = _order_places(spark, sf_dir)
    return reduce_to_deepest(links, tree, "orderkey", "place", "place", "parent")


def _three_levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same with a world, 2000, above the regions, to which every third order is linked."""
    links, tree = _order_places(spark, sf_dir)
    world = _read(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1000).alias("place"), F.lit(2000).alias("parent")
    )
    everywhere = _read(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    linked = links.unionByName(everywhere.select(F.col("o_orderkey").alias("orderkey"), F.lit(2000).alias("place")))
    return linked, tree.unionByName(world)


def reduce_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, tree = _three_levels(spark, sf_dir)
    return reduce_to_deepest_of_all(links, tree, "orderkey", "place", "place", "parent", _scratch(spark))


def tree_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tree = _three_levels(spark, sf_dir)
    return ancestors(tree, "place", "parent", _scratch(spark))


# --- assets -----------------------------------------------------------------

ASSET_CATALOG = Catalog(
    [
        table("pages", [column("page_id", LONG, key=True), column("url", TEXT, asset=True)], target="pages"),
        table(
            "documents",
            [column("doc_id", LONG, key=True), column("source", TEXT, asset=True)],
            target="documents",
        ),
    ]
)


def _tables_with_paths(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    # Blank: em space and no-break space; space, tab and information separator.
    blank = F.when(F.col("page_id") % 10 == 0, F.lit("\u2003\u00a0")).otherwise(F.lit(" \t\x1f"))
    url = F.when(F.col("page_id") % 5 == 0, blank).otherwise(F.col("url"))
    return {
        "pages": _read(spark, sf_dir, "pages").withColumn("url", url),
        "documents": _read(spark, sf_dir, "documents"),
    }


def asset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, ASSET_CATALOG, _tables_with_paths(spark, sf_dir))


def distinct_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_texts(_tables_with_paths(spark, sf_dir)["pages"], "url")


def _files_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths below the tables' own folder: two name a file there, the nations' names do not."""
    path = (
        F.when(F.col("n_regionkey") == 0, F.lit("region.parquet"))
        .when(F.col("n_regionkey") == 1, F.lit("nation.parquet"))
        .when(F.col("n_regionkey") == 2, F.concat(F.lit("../"), F.col("n_name")))
        .otherwise(F.col("n_name"))
    )
    spec = table("nation", [column("file", TEXT, asset=True)], target="nation")
    df = _read(spark, sf_dir, "nation").withColumn("file", path)
    return manifest(spark, Catalog([spec]), {"nation": df})


def asset_full_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _files_of_nations(spark, sf_dir).unionByName(
        manifest(spark, ASSET_CATALOG, _tables_with_paths(spark, sf_dir))
    )
    return paths.select("path", below("/shop/images/", F.col("path")).alias("full_path"))


def asset_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = manifest(spark, ASSET_CATALOG, _tables_with_paths(spark, sf_dir))
    return with_presence(urls.unionByName(_files_of_nations(spark, sf_dir)), sf_dir).drop("length")


def asset_presence_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = manifest(spark, ASSET_CATALOG, _tables_with_paths(spark, sf_dir))
    paths = urls.unionByName(_files_of_nations(spark, sf_dir))
    return with_listed_presence(paths, list_files(spark, sf_dir, _scratch(spark))).drop("length")


def asset_publish_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation's customers as a file of its own; published with the nations' names, which name no file."""
    scratch = _scratch(spark)
    files = _read(spark, sf_dir, "customer").repartition("c_nationkey").select("c_nationkey", "c_name")
    files.sortWithinPartitions("c_nationkey").write.partitionBy("c_nationkey").text(f"{scratch}/files")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    written = listed.load(f"{scratch}/files").select(F.regexp_extract("path", "/files/(.*)$", 1).alias("path"))
    names = _files_of_nations(spark, sf_dir).select("path")
    folders = _read(spark, sf_dir, "customer").select(F.concat(F.lit("c_nationkey="), "c_nationkey").alias("path"))
    paths = written.unionByName(names).unionByName(folders)
    return publish_counts(publish(paths, f"{scratch}/files", f"{scratch}/published", f"{scratch}/report", tasks=4))


# --- quality ----------------------------------------------------------------


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    )
    spec = table("customer", [column("c_custkey", LONG, key=True)], target="customer")
    return profile(df, spec)


QUALITY_CUSTOMER = table(
    "customer",
    [
        column("c_custkey", LONG, key=True, nullable=False),
        column("c_name", TEXT, nullable=False),
        column("c_acctbal", DecimalType(15, 2), min_value=0, max_value=9000),
        column("c_mktsegment", TEXT, max_length=9),
    ],
    target="customer",
)


def quality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "customer").withColumn(
        "c_name", F.when(F.col("c_nationkey") != 3, F.col("c_name"))
    )
    return violations(normalize(df, QUALITY_CUSTOMER), QUALITY_CUSTOMER)


def fill_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = table(
        "orders",
        [
            column("o_orderkey", LONG, key=True),
            column("o_orderstatus", TEXT, rule="value_to_none", args={"gauge": "P"}, default="N/A"),
        ],
        target="orders",
    )
    return fill_defaults(normalize(_read(spark, sf_dir, "orders"), spec), spec)


def key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- sinks and stages, written and read back --------------------------------


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark)
    write_table(_read(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    # Spark would otherwise guess a type for the folder names.
    return read_table(spark, path, _read(spark, sf_dir, "orders").schema)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, line breaks, NULLs and empty texts through the bulk-load format."""
    lang = F.when(F.col("doc_id") % 3 != 0, F.when(F.col("doc_id") % 3 == 1, F.lit("")).otherwise(F.col("lang")))
    df = _read(spark, sf_dir, "documents").withColumn("lang", lang)
    path = _scratch(spark)
    write_csv(df, path, chunk_size=100_000)
    return read_csv(spark, path, df.schema)


def quarantine_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = sweep(LINE_CATALOG, _line_tables(spark, sf_dir))
    path = _scratch(spark)
    write_quarantine(quarantine, path)
    return read_table(spark, f"{path}/lineitem")


def stage_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep two stages, then start a later one from what they kept."""
    raw = {"customer": _read(spark, sf_dir, "customer"), "orders": _orders_with_text_dates(spark, sf_dir)}
    store = StageStore(spark, _scratch(spark))
    clean(TRADE_CATALOG, raw, stages=["NORMALIZE", "DEDUP"], dedup_rules=TRADE_DEDUP, store=store)
    result = clean(TRADE_CATALOG, names=["customer", "orders"], stages=["INTEGRITY"], store=store)
    return result.tables["orders"]


# --- the whole job ----------------------------------------------------------

TRADE_CATALOG = Catalog(
    [
        # nation is joined before region, whose key it brings.
        table(
            "nation",
            [
                column("n_nationkey", INT, key=True),
                column("n_name", TEXT),
                column("n_regionkey", INT, references="region", on_delete=DO_NOTHING),
            ],
            target="target_nation",
            join_to=JoinInto("customer", "c_nationkey"),
        ),
        replace(REGION, join_to=JoinInto("customer", "n_regionkey")),
        table(
            "customer",
            [
                column("c_custkey", LONG, key=True),
                column("c_name", TEXT),
                column("c_nationkey", INT, references="nation", on_delete=SET_NULL),
                column("c_mktsegment", TEXT, rule="value_to_none", args={"gauge": "MACHINERY"}),
            ],
            target="target_customer",
        ),
        table(
            "orders",
            [
                column("o_orderkey", LONG, key=True),
                column("o_custkey", LONG, references="customer", on_delete=CASCADE),
                column("o_orderstatus", TEXT),
                column("o_totalprice", DecimalType(15, 2)),
                column("o_orderdate", TIME, rule="normalize_date"),
            ],
            target="target_orders",
        ),
    ]
)
TRADE_DEDUP = {"orders": DedupRule(("o_custkey", "o_orderdate"))}


def _raw_trade(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "nation": _moved(_read(spark, sf_dir, "nation"), "n_nationkey", "n_nationkey <> 7"),
        "region": _read(spark, sf_dir, "region"),
        "customer": _customers(spark, sf_dir),
        "orders": _orders_with_text_dates(spark, sf_dir),
    }


def _clean_trade(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return clean(TRADE_CATALOG, _raw_trade(spark, sf_dir), dedup_rules=TRADE_DEDUP).tables


def clean_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise, deduplicate, enforce keys, join: the cleaned orders as their target wants them."""
    return project_to_target(_clean_trade(spark, sf_dir)["orders"], TRADE_CATALOG["orders"])


def clean_catalog_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job's customers, with nation and region folded in."""
    customers = _clean_trade(spark, sf_dir)["customer"]
    return project_to_target(
        customers, TRADE_CATALOG["customer"], [TRADE_CATALOG["nation"], TRADE_CATALOG["region"]]
    )


def clean_catalog_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job's tables under their target names; the orders of them."""
    return project_all(TRADE_CATALOG, _clean_trade(spark, sf_dir))["target_orders"]


def clean_catalog_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the job sets aside, read from the same written tables as the rows it keeps."""
    result = clean(TRADE_CATALOG, _raw_trade(spark, sf_dir), dedup_rules=TRADE_DEDUP, work_dir=_scratch(spark))
    kept = result.tables["orders"].select("o_orderkey", F.lit("kept").alias("state"))
    return kept.unionByName(result.quarantine["orders"].select("o_orderkey", F.col("_fk").alias("state")))


PLACES_CATALOG = Catalog(
    [
        table("places", [column("place", INT, key=True), column("parent", INT)], target="places"),
        table("links", [column("orderkey", LONG), column("place", INT)], target="links"),
    ]
)
PLACES_REDUCE = {"links": ReduceRule("places", "orderkey", "place", "place", "parent")}


def clean_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reduce stage run as part of the job."""
    links, tree = _order_places(spark, sf_dir)
    result = clean(
        PLACES_CATALOG,
        {"links": links, "places": tree},
        stages=["NORMALIZE", "REDUCE"],
        reduce_rules=PLACES_REDUCE,
    )
    return result.tables["links"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        fk_orphans,
        fk_cascade,
        fk_set_null,
        fk_do_nothing,
        fk_do_nothing_quarantine,
        fk_zero_as_null,
        fk_broken_keys,
        fk_sweep,
        fk_sweep_two_pass,
        fk_quarantine,
        fk_orphan_counts,
        fk_cascade_transitive,
        fk_cascade_cycle,
        fk_cascade_cycle_quarantine,
        key_semi,
        key_exists,
        zero_to_null,
        value_to_null,
        zero_date,
        int_to_bool,
        html_unescape,
        normalize_table,
        user_rule,
        row_filter,
        cast_lenient,
        cast_rejects,
        dedup_first,
        dedup_last,
        dedup_any,
        dedup_none,
        dedup_lines,
        distinct_brands,
        left_join_lookup,
        left_join_repeated,
        left_join_chain,
        target_projection,
        declared_projection,
        reduce_hierarchy,
        reduce_levels,
        tree_ancestors,
        asset_manifest,
        distinct_paths,
        asset_full_paths,
        asset_presence,
        asset_presence_listed,
        asset_publish_counts,
        table_profile,
        quality_violations,
        fill_default,
        key_unique,
        parquet_round_trip,
        csv_round_trip,
        quarantine_round_trip,
        stage_restore,
        clean_catalog,
        clean_catalog_customers,
        clean_catalog_targets,
        clean_catalog_quarantine,
        clean_links,
    )
}
