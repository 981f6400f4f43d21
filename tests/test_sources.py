"""CSV extracts and their names."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from starfeed.registry import write_csv
from starfeed.sources import SOURCES, csv, land, load_sources, misfits, read_csv, source_path
from starfeed.sources.csv import fitting_types


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_paths():
    assert len(SOURCES) == 18
    assert source_path("s3a://b/", "usuarios") == "s3a://b/cliente_users.csv"
    assert source_path("d", "imagenes_producto", folders=True) == "d/marketplace/imagenes_producto.csv"
    assert source_path("d", "delivery_pedidos", folders=True) == "d/delivery/pedidos.csv"


def test_quotes_line_breaks_and_ragged_rows(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,t\n1,"two\nlines, and ""quotes"""\n2\n3,x,surplus\n,y\n')
    got = {r["t"]: r["id"] for r in read_csv(spark, path, {"id": T.LongType()}).collect()}
    assert got == {'two\nlines, and "quotes"': 1, None: 2, "x": 3, "y": None}


LONG, INT, REAL, MONEY = T.LongType(), T.IntegerType(), T.DoubleType(), T.DecimalType(18, 2)


@pytest.mark.parametrize(
    "declared, texts, kind, values",
    [
        (REAL, ["0.00012345", "1.239"], "double", [0.00012345, 1.239]),
        (MONEY, ["0.00012345", "1.2"], "string", ["0.00012345", "1.2"]),
        (MONEY, ["1.20", "3"], "decimal(18,2)", [Decimal("1.20"), Decimal("3.00")]),
        (INT, ["4.5", "3"], "double", [4.5, 3.0]),
        (INT, ["4", "30000000000"], "bigint", [4, 30000000000]),
        (LONG, ["3f2a-uu", "7"], "string", ["3f2a-uu", "7"]),
        (LONG, ["9" * 25, "7"], "decimal(38,0)", [Decimal("9" * 25), Decimal(7)]),
        (REAL, ["0.123456789012345678", "2"], "decimal(38,18)", [Decimal("0.123456789012345678"), Decimal(2)]),
        (REAL, ["0.1234567890123456789", "2"], "string", ["0.1234567890123456789", "2"]),
        (LONG, [" 5 ", ""], "bigint", [5, None]),
    ],
)
def test_no_value_is_lost_to_a_type(spark, tmp_path, declared, texts, kind, values):
    path = write(tmp_path / "a.csv", "x,k\n" + "".join(f'"{t}",{i}\n' for i, t in enumerate(texts)))
    df = read_csv(spark, path, {"x": declared})
    assert df.dtypes[0] == ("x", kind)
    assert [r["x"] for r in df.orderBy("k").collect()] == values


def test_misfits_are_counted(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "2.5"), (None, "2")], "id string, n string")
    got = misfits(raw, {"id": LONG, "n": INT})
    assert {r["columna"]: r["desajustes"] for r in got.collect()} == {"id": 1, "n": 2}


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "extra,id\nz,5\n")
    df = read_csv(spark, path, {"id": T.LongType()})
    assert df.dtypes == [("extra", "string"), ("id", "bigint")]
    assert tuple(df.first()) == ("z", 5)


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "id,t\n1,a\n")
    write(tmp_path / "d" / "2.csv", "t,id\nb,2\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ"):
        read_csv(spark, str(tmp_path / "d"), {"id": T.LongType()}).collect()


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,x,d\n1,2.5,2024-01-01 10:00:00\n")
    assert [t for _, t in read_csv(spark, path).dtypes] == ["int", "double", "timestamp"]


@pytest.mark.parametrize("folders", [False, True])
def test_load_renames_and_types(spark, tmp_path, folders):
    base = str(tmp_path)
    texts = {
        "pedidos": "id,user,estado,fechaCreacion,metodoPago,otra\n1,2,OK,2024-03-31T10:00:00,CRIPTO,9\n",
        "productos": "producto_id,precio\n1,12.50\n",
        "wallets": "id,saldo\n1,2.5\n",
    }
    for name, text in texts.items():
        path = tmp_path / source_path("", name, folders).lstrip("/")
        write(path, text)
    got = load_sources(spark, base, texts, folders, {"wallets": {"saldo": T.DoubleType()}}, splittable=["wallets"])
    assert got["pedidos"].columns == [
        "pedido_id", "cliente_id_pedido", "estado_pedido", "fechaCreacion", "metodoPago", "otra",
    ]
    assert got["pedidos"].first()["fechaCreacion"] == datetime(2024, 3, 31, 10)
    assert got["productos"].first()["precio"] == 12.5
    landed = land(got, str(tmp_path / "landed"))
    assert tuple(landed["wallets"].first()) == (1, 2.5)
    assert landed["pedidos"].schema == got["pedidos"].schema


def test_wider_types_are_tried_only_where_the_declared_one_fails(spark, monkeypatch):
    tried, given = [], csv.misfit
    monkeypatch.setattr(csv, "misfit", lambda text, kind: tried.append(kind.simpleString()) or given(text, kind))
    raw = spark.createDataFrame([("1", "x", "1.5", "2024-01-01"), (None, "2", "2", "?")], "a string, b string, c string, d string")
    types = {"a": T.LongType(), "b": T.LongType(), "c": T.IntegerType(), "d": T.TimestampType()}
    assert fitting_types(raw, types) == {"a": T.LongType(), "b": T.StringType(), "c": T.DoubleType(), "d": T.StringType()}
    assert tried == ["bigint", "bigint", "int", "timestamp", "bigint", "double", "decimal(38,18)"]


def test_a_large_extract_is_a_folder_of_files(spark, tmp_path):
    """One with line breaks in its fields is read by as many tasks as it has files."""
    path = str(tmp_path / "many.csv")
    write_csv(spark.range(450_000).coalesce(1).withColumn("t", F.lit("a\nb")), path)
    assert len(list(Path(path).glob("*.csv"))) == 3
    assert read_csv(spark, path, {"id": T.LongType()}).agg(F.sum("id"), F.count("t")).first() == (450_000 * 449_999 // 2, 450_000)
