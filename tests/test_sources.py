import os
import tempfile

from lumen.plans import roles as R
from lumen.sources import tables as S
from conftest import SMALL


def test_csv_na_and_sanitize(spark):
    d = tempfile.mkdtemp(prefix="lumen-test-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("State.Name,Murder.Rate,Assault\nA,1.5,NA\nB,,3\n")
    raw = S.read_csv(spark, p)
    assert dict(raw.dtypes)["Assault"] == "string"          # NA text makes it a string
    df = S.sanitize_columns(S.read_csv(spark, p, null_value="NA"))
    assert df.columns == ["State_Name", "Murder_Rate", "Assault"]
    assert dict(df.dtypes)["Assault"] == "int"
    assert sorted(tuple(r) for r in df.collect()) == [("A", 1.5, None), ("B", None, 3)]


def test_save_table_roundtrip_and_catalog(spark):
    d = tempfile.mkdtemp(prefix="lumen-test-tbl-")
    S.save_table(R.airports(spark, SMALL), "t_airports", path=os.path.join(d, "t"))
    assert S.scan_table(spark, "t_airports").count() == R.airports(spark, SMALL).count()
    names = [r.tableName for r in S.show_tables(spark, "t_air*").collect()]
    assert "t_airports" in names
    desc = S.describe_table(S.scan_table(spark, "t_airports")).collect()
    assert [(r.col_name, r.data_type) for r in desc] == [("faa", "bigint"), ("name", "string")]


def test_file_inventory_prunes_content(spark):
    inv = S.file_inventory(spark, SMALL, glob="*.parquet")
    assert inv.columns == ["path", "length", "modificationTime"]
    assert inv.count() == len([f for f in os.listdir(SMALL) if f.endswith(".parquet")])
