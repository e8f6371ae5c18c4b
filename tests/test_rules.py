import datetime as dt
import html
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, StringType, TimestampNTZType

from tablemend import ContractError, column, table
from tablemend.functions import apply_rule, below, has_text, register_rule
from tablemend.operators import normalize, normalize_lenient, rejects


def _apply(spark, ddl, values, rule, **args):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return [r[0] for r in df.select(apply_rule(rule, F.col("x"), df.schema["x"].dataType, args)).collect()]


def test_zero_to_none(spark):
    assert _apply(spark, "int", [0, 1, -1, None], "zero_to_none") == [None, 1, -1, None]
    assert _apply(spark, "double", [0.0, -0.0, 0.5], "zero_to_none") == [None, None, 0.5]
    assert _apply(spark, "decimal(5,2)", [Decimal("0.00"), Decimal("0.01")], "zero_to_none") == [None, Decimal("0.01")]
    assert _apply(spark, "boolean", [False, True], "zero_to_none") == [None, True]
    assert _apply(spark, "string", ["0", ""], "zero_to_none") == ["0", ""]


def test_value_to_none_is_exact_and_case_sensitive(spark):
    values = ["none", "None", " none", "", None]
    assert _apply(spark, "string", values, "value_to_none", gauge="none") == [None, "None", " none", "", None]
    assert _apply(spark, "string", ["", "x"], "value_to_none", gauge="") == [None, "x"]
    assert _apply(spark, "int", [5, 6], "value_to_none", gauge=5) == [None, 6]


def test_value_to_none_leaves_other_types_alone(spark):
    day = dt.date(2026, 1, 1)
    assert _apply(spark, "date", [day, None], "value_to_none", gauge="0000-00-00") == [day, None]
    assert _apply(spark, "string", ["5"], "value_to_none", gauge=5) == ["5"]
    assert _apply(spark, "int", [1, 0], "value_to_none", gauge=True) == [1, 0]


def test_normalize_date(spark):
    values = ["0000-00-00", "0000-00-00 00:00:00", "0000-00-00 00:00", "2026-01-01", "", None]
    assert _apply(spark, "string", values, "normalize_date") == [None, None, *values[2:]]


def test_int_to_bool_is_false_for_null(spark):
    assert _apply(spark, "tinyint", [0, 1, 2, -1, None], "int_to_bool") == [False, True, True, True, False]
    assert _apply(spark, "boolean", [True, None], "int_to_bool") == [True, False]
    assert _apply(spark, "string", ["0", "", None], "int_to_bool") == [True, False, False]
    assert _apply(spark, "date", [dt.date(2026, 1, 1), None], "int_to_bool") == [True, False]


HTML = [
    "plain",
    "",
    None,
    "&lt;p&gt;a &amp; b&lt;/p&gt;",
    "&amp;lt;",  # one pass only
    "&eacute;&#233;&#xE9;&#x80;&notit;&NotEqualTilde;&amp",
    "a & b &unknown; &",
    "&#0;&#x110000;",
    "&quot;" * 1000,
]


def test_to_html_matches_a_single_unescape(spark):
    assert _apply(spark, "string", HTML, "to_html") == [None if v is None else html.unescape(v) for v in HTML]


def test_to_html_over_many_batches(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("a &amp; b")).when(F.col("id") % 3 == 1, F.lit("plain")).alias("x")
    )
    out = df.select(apply_rule("to_html", F.col("x"), StringType()).alias("x"))
    assert {r["x"]: r["count"] for r in out.groupBy("x").count().collect()} == {
        "a & b": 10_000,
        "plain": 10_000,
        None: 10_000,
    }


def test_unknown_rule():
    with pytest.raises(KeyError, match="unknown value rule 'nope'"):
        apply_rule("nope", None, StringType())


def test_register_rule(spark):
    register_rule("prefix", lambda value, data_type, text: F.concat(F.lit(text), value))
    assert _apply(spark, "string", ["a", None], "prefix", text="x-") == ["x-a", None]


def test_has_text_agrees_with_arrow_on_every_character(spark):
    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "c int, x string")
    blank = {r["c"] for r in df.where(~has_text(F.col("x"))).collect()}
    trimmed = pc.utf8_length(pc.utf8_trim_whitespace(pa.array([chr(c) for c in codes]))).to_pylist()
    assert blank == {c for c, n in zip(codes, trimmed, strict=True) if n == 0}


def test_has_text(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t\n",), ("\u3000\u00a0",), (" a ",), ("\n\nx",)], "x string")
    assert [r[0] for r in df.select(has_text(F.col("x"))).collect()] == [False, False, False, False, True, True]


def test_below_keeps_to_the_base_folder(spark):
    paths = ["a/b.png", "../a", "a/../b", "/etc/x", "C:/x", "s3://b/k", "a..b/c", "..", "a/..", "\\x", "a:b"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(below("/base/", F.col("p"))).collect()]
    assert got == ["/base/a/b.png", None, None, None, None, None, "/base/a..b/c", None, None, None, "/base/a:b"]


SPEC = table(
    "t",
    [
        column("id", IntegerType(), key=True),
        column("flag", BooleanType(), rule="int_to_bool"),
        column("day", DateType(), rule="value_to_none", args={"gauge": "0000-00-00"}),
        column("at", TimestampNTZType(), rule="normalize_date"),
        column("price", DecimalType(15, 4)),
    ],
    "t",
)
RAW = "price string, id string, extra int, flag tinyint, day string, at string"


def test_normalize_projects_rules_and_casts(spark):
    df = spark.createDataFrame(
        [
            ("1.5", "7", 1, 1, "2026-01-02", "2026-01-02 03:04:05"),
            (None, "8", 1, None, "0000-00-00", "0000-00-00 00:00:00"),
        ],
        RAW,
    )
    out = normalize(df, SPEC)
    assert out.schema.simpleString() == SPEC.schema.simpleString()
    assert [tuple(r) for r in out.collect()] == [
        (7, True, dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5), Decimal("1.5000")),
        (8, False, None, None, None),
    ]


def test_normalize_keeps_column_facts(spark):
    out = normalize(spark.createDataFrame([], RAW), SPEC)
    assert out.schema["flag"].metadata["rule"] == "int_to_bool"
    assert out.count() == 0


def test_normalize_is_strict_and_lenient_on_request(spark):
    df = spark.createDataFrame([("x", "1", 0, 0, "2026-01-02", None), ("2", "2", 0, 0, None, None)], RAW)
    with pytest.raises(PySparkException):
        normalize(df, SPEC).collect()
    assert [r["price"] for r in normalize_lenient(df, SPEC).orderBy("id").collect()] == [None, Decimal("2.0000")]
    found = rejects(df, SPEC).collect()
    assert [(r["id"], r["_columns"]) for r in found] == [("1", "price")]


def test_normalize_needs_every_declared_column(spark):
    with pytest.raises(ContractError, match="missing columns"):
        normalize(spark.createDataFrame([], "id int"), SPEC)
