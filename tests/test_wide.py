from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomgraph.functions.cells import cell_reader, tidy
from loomgraph.operators.wide import long_cells, typed, wide_cells

TYPES = [("hasPageCount", "page_count", "int", "pages"), ("hasRuntime", "runtime_minutes", "int", "minutes"), ("hasItemWeight", "weight_g", "double", "g"), ("hasListPrice", "list_price", "double", "USD"), ("hasReleaseDate", "release_date", "date", None), ("isWaterResistant", "water_resistant", "boolean", None), ("hasBrand", "brand", "string", None)]
SCHEMA = "row_id bigint, subject string, relation string, value string, loaded_at timestamp, brand string"


@pytest.mark.parametrize(
    "kind,unit,value,cell",
    [
        ("int", "pages", "approx. 1,480 pages", "1480"), ("int", "pages", "959pp", "959"), ("int", "pages", "1.480", None), ("int", "pages", "?", None), ("int", "minutes", "1:22:00", "82"),
        ("int", "minutes", "PT3H22M", "202"), ("int", "minutes", "2 hours and 4 minutes", "124"), ("int", "minutes", "48 min", "48"), ("int", "minutes", "203", "203"), ("int", "minutes", "", None), ("int", "minutes", "pt", None),
        ("double", "g", "5.57 kg", "5570.0"), ("double", "g", "1,83lb", "830.1"), ("double", "g", "76,3 Oz", "2163.1"), ("double", "g", "2158", "2158.0"), ("double", "g", "3 stone", None),
        ("double", "USD", "US$1,059.19", "1059.19"), ("double", "USD", "2.064,90 $", "2064.90"), ("double", "USD", "17,67", "17.67"), ("double", "USD", "17", None),
        ("date", None, "09.05.2018", "2018-05-09"), ("date", None, "07/27/2018", "2018-07-27"), ("date", None, "20170519", "2017-05-19"), ("date", None, "July 1, 2003", "2003-07-01"), ("date", None, "8 February 2015", "2015-02-08"),
        ("date", None, "31.02.2018", None), ("date", None, "2000/11/02", "2000-11-02"), ("boolean", None, " Y ", "true"), ("boolean", None, "0", "false"), ("boolean", None, "maybe", None), ("string", None, "  ", None), ("string", None, " x", " x"),
    ],
)
def test_cells(spark, kind, unit, value, cell):
    df = spark.createDataFrame([(value,)], "v string").withColumn("t", tidy(F.col("v")))
    assert df.select(cell_reader(kind, unit)[0](F.col("v"), F.col("t"))).first()[0] == cell


def _types(spark):
    return spark.createDataFrame(TYPES, "relation string, column_name string, data_type string, unit string")


def test_latest_readable_value_wins(spark):
    a, b = dt(2023, 1, 1), dt(2023, 1, 2)
    rows = [
        (1, "X ##p1", "hasListPrice", "$1.00", a, "c"), (2, "X ##P1 ", "hasListPrice", "$2.00", b, "c"), (3, "X ##p1", "hasListPrice", "ask seller", b, "c"), (4, "X ##p1", "hasPageCount", "10", a, "c"),
        (5, "X ##p1", "hasPageCount", "11", a, "c"), (6, "Y ##2 ##P2", "hasBrand", "Acme", None, "c"), (7, None, "hasBrand", "Acme", a, "c"), (8, "no id", "hasBrand", "Acme", a, "c"), (9, "Z ##P3", None, "v", a, "c"),
        (10, "Z ##P3", "hasBrand", None, a, "c"), (5, "X ##p1", "hasPageCount", "11", a, "c"), (11, "W ##P4", "hasSubtype", "v", a, "c"),
    ]
    w = wide_cells(spark.createDataFrame(rows, SCHEMA), _types(spark), dense_tables=1)
    got = {r.product_id: r.asDict() for r in w.collect()}
    assert set(got) == {"P1", "P2"}
    assert got["P1"]["list_price"] == "2.00" and got["P1"]["page_count"] == "11" and got["P1"]["brand"] is None
    t = typed(w, _types(spark))
    assert dict(t.dtypes)["release_date"] == "date" and t.filter("product_id = 'P1'").first().list_price == 2.0
    assert sorted((r.product_id, r.column_name, r.cell) for r in long_cells(w, _types(spark)).collect()) == [("P1", "list_price", "2.00"), ("P1", "page_count", "11")]


def test_empty(spark):
    assert wide_cells(spark.createDataFrame([], SCHEMA), _types(spark)).count() == 0
