"""Types that change from load to load, and keys that are compared across them."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from starfeed.functions.widening import TEXT, WIDE, holds, key_text, widest
from starfeed.operators import new_rows
from starfeed.sinks import JdbcWarehouse, ParquetWarehouse
from starfeed.sources import Database

INT, LONG, REAL = T.IntegerType(), T.LongType(), T.DoubleType()


@pytest.fixture
def database(tmp_path):
    return Database(
        f"jdbc:derby:{tmp_path}/db;create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        lookup="select TABLENAME from SYS.SYSTABLES where TABLENAME = upper('{table}')",
    )


@pytest.fixture(params=["parquet", "jdbc"])
def warehouse(request, spark, tmp_path, database):
    return ParquetWarehouse(spark, str(tmp_path / "wh")) if request.param == "parquet" else JdbcWarehouse(spark, database)


def load(spark, warehouse, load_id, rows, columns, table="dim_tenants"):
    warehouse.begin(load_id)
    warehouse.finish(load_id, {table: warehouse.append(table, spark.createDataFrame(rows, columns), load_id)})


CASES = [
    ("int", [1], "long", [2**40], "bigint", [1, 2**40]),
    ("long", [7], "string", ["p-9"], "string", ["7", "p-9"]),
    ("double", [0.5, 1e10], "decimal(38,18)", [Decimal("5.000000000000000001")], "decimal(38,18)", [Decimal("0.5"), Decimal("1e10"), Decimal("5.000000000000000001")]),
    ("double", [1e300], "decimal(38,18)", [Decimal("5.000000000000000001")], "string", ["1.0E300", "5.000000000000000001"]),
    ("double", [1e300], "decimal(38,18)", [Decimal("0.25")], "double", [1e300, 0.25]),
    ("long", [5], "double", [0.5], "double", [5.0, 0.5]),
    ("long", [2**53 + 1], "double", [0.5], "decimal(38,18)", [Decimal(2**53 + 1), Decimal("0.5")]),
    ("boolean", [True], "int", [3], "string", ["true", "3"]),
    ("date", [date(2024, 1, 2)], "timestamp", [datetime(2024, 1, 3, 4)], "timestamp", [datetime(2024, 1, 2), datetime(2024, 1, 3, 4)]),
    ("string", ["a"], "long", [None], "string", ["a", None]),
]


@pytest.mark.parametrize("first, a, second, b, kind, values", CASES)
def test_no_load_is_lost_to_a_type(spark, tmp_path, first, a, second, b, kind, values):
    warehouse = ParquetWarehouse(spark, str(tmp_path / "wh"))
    load(spark, warehouse, "d1", [(i, x) for i, x in enumerate(a)], f"n int, v {first}")
    load(spark, warehouse, "d2", [(10 + i, x) for i, x in enumerate(b)], f"n int, v {second}")
    got = warehouse.stored("dim_tenants")
    assert got.dtypes == [("n", "int"), ("v", kind)]
    assert [r["v"] for r in got.orderBy("n").collect()] == values
    again = ParquetWarehouse(spark, str(tmp_path / "wh")).stored("dim_tenants", ["v"])
    assert again.count() == len(values)


def test_columns_and_types_over_many_loads(spark, warehouse):
    load(spark, warehouse, "d1", [(1, 5)], "tenant_id long, n int")
    load(spark, warehouse, "d2", [(2, 2.5, "x")], "tenant_id long, n double, otra string")
    load(spark, warehouse, "d3", [("t-3", 7)], "tenant_id string, n int")
    load(spark, warehouse, "d4", [(4, 8)], "tenant_id long, n int")
    got = sorted(map(tuple, warehouse.stored("dim_tenants", ["tenant_id", "n", "otra"]).collect()), key=str)
    assert got == [("1", 5.0, None), ("2", 2.5, "x"), ("4", 8.0, None), ("t-3", 7.0, None)]
    unseen = spark.createDataFrame([("4",), ("1",), ("t-3",), ("t-4",)], "tenant_id string")
    for df in (unseen, unseen.coalesce(1)):
        left = warehouse.unseen("dim_tenants", df, ["tenant_id"], "d5", True, 100, 10**9)
        assert [r[0] for r in left.collect()] == ["t-4"]


def test_a_log_without_types_is_read_by_the_files(spark, tmp_path):
    """As written before types were recorded."""
    root = str(tmp_path / "wh")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(f"{root}/dim_tenants/load_id=d1")
    line = spark.createDataFrame([("d1", "dim_tenants", 1, None)], "load_id string, table string, rows long, mark date")
    line.write.parquet(f"{root}/load_log")
    warehouse = ParquetWarehouse(spark, root)
    load(spark, warehouse, "d2", [("x-2", "b")], "id string, v string")
    assert sorted(map(tuple, warehouse.stored("dim_tenants").collect())) == [("1", "a"), ("x-2", "b")]


def test_a_failed_load_leaves_the_types(spark, tmp_path):
    warehouse = ParquetWarehouse(spark, str(tmp_path / "wh"))
    load(spark, warehouse, "d1", [(1,)], "id long")
    warehouse.begin("d2")
    warehouse.append("dim_tenants", spark.createDataFrame([("x",)], "id string"), "d2")
    assert warehouse.stored("dim_tenants").dtypes == [("id", "bigint")]


def test_rows_of_other_programs_count(spark, database):
    """A table without an attempt, and rows whose attempt is NULL."""
    database.append(spark.createDataFrame([(1, "a")], "tenant_id long, v string"), "dim_tenants")
    database.append(spark.createDataFrame([(1, "a", None, None)], "tenant_id long, v string, load_attempt long, load_row long"), "dim_catalogos")
    warehouse = JdbcWarehouse(spark, database)
    warehouse.begin("d1")
    for table in ("dim_tenants", "dim_catalogos"):
        more = spark.createDataFrame([(1, "a"), (2, "b")], "tenant_id long, v string")
        assert warehouse.append(table, warehouse.unseen(table, more, ["tenant_id"], "d1", True, 100, 10**9), "d1") == 1
        assert warehouse.stored(table).count() == 1
    warehouse.finish("d1", {})
    for table in ("dim_tenants", "dim_catalogos"):
        assert sorted(map(tuple, warehouse.stored(table).collect())) == [(1, "a"), (2, "b")]
        assert warehouse.mark(table, "tenant_id") == 2


def test_a_task_written_twice_is_read_once(spark, database, monkeypatch):
    warehouse, append = JdbcWarehouse(spark, database), Database.append

    def lost_after_its_commit(self, df, table):
        if table == "dim_tenants":
            append(self, df.where(F.spark_partition_id() == 0), table)
        return append(self, df, table)

    rows = spark.range(100).select((F.col("id") % 7).alias("tenant_id")).repartition(4)
    warehouse.begin("d1")
    with monkeypatch.context() as patch:
        patch.setattr(Database, "append", lost_after_its_commit)
        assert warehouse.append("dim_tenants", rows, "d1") == 100
    assert database.read(spark, "dim_tenants").count() > 100
    warehouse.finish("d1", {})
    warehouse.begin("d2")
    warehouse.append("dim_tenants", rows.limit(5), "d2")
    warehouse.finish("d2", {})
    counts = {r[0]: r[1] for r in warehouse.stored("dim_tenants").groupBy("tenant_id").count().collect()}
    assert sum(counts.values()) == 105 and all(n >= 14 for n in counts.values())


def test_rows_that_did_not_arrive_are_an_error(spark, database, monkeypatch):
    warehouse = JdbcWarehouse(spark, database)
    warehouse.begin("d1")
    append = Database.append
    monkeypatch.setattr(Database, "append", lambda self, df, table: append(self, df.limit(3), table))
    with pytest.raises(RuntimeError, match="10 rows were sent and 3 are stored"):
        warehouse.append("dim_tenants", spark.range(10), "d1")


def test_which_type_holds_which():
    assert holds(LONG, INT) and holds(REAL, INT) and holds(WIDE, LONG) and holds(TEXT, WIDE)
    assert holds(REAL, LONG) is None and holds(WIDE, REAL) is None
    assert not holds(INT, LONG) and not holds(LONG, REAL) and not holds(WIDE, T.DecimalType(38, 0))
    assert widest(LONG, REAL, lambda kind, wide: True) == REAL
    assert widest(LONG, REAL, lambda kind, wide: False) == TEXT
    assert widest(INT, T.DecimalType(18, 2), lambda kind, wide: True) == T.DecimalType(18, 2)
    assert widest(T.DecimalType(18, 2), T.DecimalType(10, 4), lambda kind, wide: False) == WIDE


@pytest.mark.parametrize(
    "kind, value, text",
    [
        ("int", 7, "7"), ("double", 7.0, "7"), ("double", 0.5, "0.5"), ("decimal(10,2)", Decimal("7.00"), "7"), ("decimal(10,2)", Decimal("7.10"), "7.1"),
        ("decimal(10,0)", Decimal("70"), "70"), ("string", " 7", " 7"), ("date", date(2024, 1, 2), "2024-01-02 00:00:00"),
        ("timestamp", datetime(2024, 1, 2, 3), "2024-01-02 03:00:00"), ("binary", bytearray(b"\x01"), "01"), ("double", None, None),
    ],
)
def test_keys_as_text(spark, kind, value, text):
    df = spark.createDataFrame([(value,)], f"k {kind}")
    assert df.select(key_text(F.col("k"), df.schema["k"].dataType)).first()[0] == text


def test_new_rows_by_keys_of_two_types(spark):
    df = spark.createDataFrame([("7", 1), ("p-9", 2), (None, 3)], "k string, v int")
    stored = spark.createDataFrame([(7,), (None,)], "k long")
    assert [r["v"] for r in new_rows(df, stored, "k").collect()] == [2]
    assert new_rows(df, stored, "k").columns == ["k", "v"]
    assert sorted(r["v"] for r in new_rows(df, stored, "k", null_safe=False, probe=10, probe_rows=0).collect()) == [2, 3]
