"""Files with their own headers and broken lines, all in one load."""

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from tabloom.sources import claim_files as C

A = 'Claim Number,Paid-Amount,"Who, exactly"\n1, 2.50 ,"Smith, J ""Jo"""\n2,x,b\n3,1,2,3\n\n4,7\n"5,1,z\n,9,\n'
B = "note/text,claim no,paid\nhello,10,1\nbye,11,\n"
COLUMNS = {"claim": "bigint", "paid": "double", "who": "string"}


@pytest.fixture()
def folder(tmp_path):
    for name, text in {"a_2024.csv": A, "b_2024.csv": B, "c_2024.csv": "x,y\n1,2\n", "d_2024.csv": ""}.items():
        (tmp_path / "in" / name[0]).mkdir(parents=True)
        (tmp_path / "in" / name[0] / name).write_text(text)
    return tmp_path


def mapping(spark):
    return spark.createDataFrame(
        [("a", "claim_number", "claim"), ("a", "paid_amount", "paid"), ("a", "who_exactly", "who"), ("b", "claim_no", "claim"),
         ("b", "paid", "paid"), ("a", "claim_no", "paid")], "client_code string, prediction_column_name string, training_column_name string")


def load(spark, folder, **more):
    client = F.substring(F.element_at(F.split("file", "/"), -1), 1, 1)
    return C.ingest_files(spark, str(folder / "in"), mapping(spark), client, COLUMNS, str(folder / "out"), str(folder / "bad"),
                          "2024-01-31", "claim", **more)


def test_rows_rejects_and_gate(spark, folder):
    gate = rows(load(spark, folder, tolerated=0), "client_code")
    assert gate == [("a", 2, 4, 1, False), ("b", 2, 0, 0, True), ("c", 0, 1, 0, False)]
    good = spark.read.parquet(str(folder / "out"))
    assert rows(good.select("client_code", *COLUMNS), "client_code", "claim") == [
        ("a", None, 9.0, None), ("a", 1, 2.5, 'Smith, J "Jo"'), ("b", 10, 1.0, None), ("b", 11, None, None)]
    bad = spark.read.parquet(str(folder / "bad"))
    assert rows(bad.select("client_code", "line", "reason"), "client_code", "line") == [
        ("a", '"5,1,z', "open quote"), ("a", "2,x,b", "unreadable value"), ("a", "3,1,2,3", "too many values"),
        ("a", "4,7", "too few values"), ("c", "1,2", "no such columns")]
    # once more: the same rows; a mended file replaces its slice only
    load(spark, folder)
    assert spark.read.parquet(str(folder / "out")).count() == 4
    (folder / "in" / "a" / "a_2024.csv").write_text("claim number,paid-amount\n7,1\n")
    load(spark, folder)
    assert rows(spark.read.parquet(str(folder / "out")).select("client_code", "claim"), "claim") == [("a", 7), ("b", 10), ("b", 11)]
    assert spark.read.parquet(str(folder / "bad")).select("client_code").distinct().collect() == [("c",)]


def test_second_header_of_each_file(spark, tmp_path):
    for i, (one, two) in enumerate([("Q1,Q2", "id,size"), ("Q1,Q2", "size,id")]):
        (tmp_path / f"f{i}.csv").write_text(f"{one}\n{two}\n{i},5\nQ1,Q2\nid,size\n")
    staged = C.stage_lines(spark, str(tmp_path), "*.csv")
    headers = C.file_headers(staged, header_rows=2)
    got = C.parse_lines(staged, headers, {"id": "string", "size": "string"}, header_rows=2)
    # lines equal to a header further down are data
    assert sorted(tuple(r) for r in got.select("id", "size", "reason").collect()) == [
        ("0", "5", None), ("5", "1", None), ("Q1", "Q2", None), ("Q2", "Q1", None), ("id", "size", None), ("size", "id", None)]


def test_files_cut_into_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("id,v\n" + "".join(f"{i},{i % 7}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        staged = C.stage_lines(spark, str(tmp_path / "big.csv"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert staged.select("block").distinct().count() > 5
    got = C.parse_lines(staged, C.file_headers(staged), {"id": "int", "v": "int"})
    assert tuple(got.agg(F.count("*"), F.sum("id"), F.count("reason")).first()) == (20_000, 199_990_000, 0)


@pytest.mark.parametrize("sep", [",", "|", "\t"])
def test_values(spark, sep):
    line = sep.join(["a", ' "b""c" ', "", f'"x{sep}y"', ' d "e" ', '""'])
    df = spark.createDataFrame([(line,), ("",)], "l string")
    got = [r[0] for r in df.select(C.values_of(F.col("l"), sep)).collect()]
    assert got == [["a", 'b"c', None, f"x{sep}y", 'd "e"', None], [None]]
