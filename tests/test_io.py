import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tabloom.operators.joins import dimension_join
from tabloom.plans.claims import run_pending
from tabloom.sources import readers, writers
from tabloom.streaming.incremental import run_incremental, stream_files


class FakeReader:
    def __init__(self):
        self.calls = {}

    def format(self, f):
        self.calls["format"] = f
        return self

    def options(self, **o):
        self.calls.update(o)
        return self

    def option(self, k, v):
        self.calls[k] = v
        return self

    def load(self):
        return self.calls


class FakeSpark:
    @property
    def read(self):
        return FakeReader()


def test_jdbc_options():
    got = readers.read_jdbc(FakeSpark(), "jdbc:x", dbtable="(select 1) t", options={"numPartitions": "8"})
    assert got == {"format": "jdbc", "url": "jdbc:x", "dbtable": "(select 1) t", "numPartitions": "8"}
    assert readers.read_query(FakeSpark(), "warehouse", "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        readers.read_jdbc(FakeSpark(), "jdbc:x")


def test_jdbc_append_options():
    seen = {}

    class W:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def mode(self, m):
            seen["mode"] = m
            return self

        def save(self):
            seen["saved"] = True

    class D:
        write = W()

    writers.append_jdbc(D(), "jdbc:x", "t")
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "mode": "append", "saved": True}


def test_replace_slice_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    path = str(tmp_path / "t")
    for _ in range(3):
        writers.replace_slice(df, path, ["k"])
    writers.replace_slice(df.where("k = 'a'").withColumn("v", F.lit(9)), path, ["k"])
    assert rows(spark.read.parquet(path).select("v", "k"), "k") == [(9, "a"), (2, "b")]


def test_an_empty_replacement_empties_its_slice(spark, tmp_path):
    df = spark.createDataFrame([(1, "a:b"), (2, "c"), (3, None)], "v int, k string")
    path = str(tmp_path / "t")
    writers.replace_slice(df, path, ["k"])
    writers.replace_slice(df.where("v > 5"), path, ["k"], [{"k": "a:b"}, {"k": None}])
    assert rows(spark.read.schema(df.schema).parquet(path).select("v", "k")) == [(2, "c")]


def test_pipe_in_data_survives(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 'q"x', None)], "x string, y string, z string")
    path = str(tmp_path / "h")
    m = writers.export_hashed(df, path, []).first()
    back = spark.read.option("sep", "|").option("header", True).option("escape", '"').csv(path)
    assert rows(back) == [("a|b", 'q"x', None)] and m["n_rows"] == 1


def test_repeated_headers_get_suffix():
    assert writers.master_names(["a", "b", "a"]) == ["a", "b", "a_MASTER"]


def test_corpus_text_and_binary(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"d{i}.xml").write_text(f"<a>{i}\né</a>", encoding="utf-8")
    a = rows(readers.read_corpus(spark, str(tmp_path), "*.xml").select("filename", "size", "content"), "filename")
    b = rows(readers.read_corpus(spark, str(tmp_path), "*.xml", binary=True).select("filename", "size", "content"), "filename")
    assert a == b and a[0][2] == "<a>0\né</a>"


def test_promote_header_keeps_or_drops(spark, tmp_path):
    (tmp_path / "y.csv").write_text("h1,h2\nname,value\nx,1\ny,2\n")
    up = readers.read_csv_promote_header(spark, {"2020": str(tmp_path / "y.csv")}, 2)
    assert up.columns == ["name", "value", "source_tag"] and up.count() == 2
    keep = readers.read_csv_promote_header(spark, {"2020": str(tmp_path / "y.csv")}, 2, promote=False)
    assert keep.columns == ["h1", "h2", "source_tag"] and keep.count() == 2


def test_salted_join_equals_broadcast(spark):
    fact = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    for how in ("inner", "left"):
        a = sorted(map(str, dimension_join(fact, dim, ["k"], how).collect()))
        b = sorted(map(str, dimension_join(fact, dim, ["k"], how, rows=0, least=3).collect()))
        assert a == b


def test_hot_and_null_keys_are_dealt_over_slices(spark):
    from tabloom.operators import joins

    rows = [("hot", 1)] * 900 + [(None, 2)] * 300 + [(f"k{i}", i) for i in range(50)]
    fact = spark.createDataFrame(rows, "k string, v int").repartition(6)
    dim = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("k1", "z"), (None, "w")], "k string, d string")
    hot = joins.hot_keys(fact, ["k"], 100).collect()
    assert [(r["k"], r["_salts"]) for r in hot] == [("hot", 9)]
    for how, n in (("inner", 1801), ("left", 1801 + 300 + 49), ("left_semi", 901)):
        out = dimension_join(fact, dim, ["k"], how, rows=0, least=100)
        want = fact.join(dim, ["k"], how)
        assert out.columns == want.columns and out.count() == n
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_pending_failures_stay_with_their_client(spark):
    ctl = spark.createDataFrame([("a", "1", "0"), ("b", "1", "0"), ("c", "0", "0"), ("d", "1", "1")],
                                "client_code string, data_load_status string, prediction_status string")

    def work(client):
        if client == "a":
            raise RuntimeError("broken file")
        return spark.range(5).withColumnRenamed("id", "claim_id")

    done = run_pending(ctl, work, "claim_id")
    assert dict(rows(done.where("prediction_error is not null").select("client_code", "prediction_error"))) == {"a": "RuntimeError: broken file"}
    out = dict(rows(done.select("client_code", "prediction_status")))
    assert out == {"a": "0", "b": "1", "c": "0", "d": "1"}


def test_a_run_merges_its_batches_once(spark, tmp_path, monkeypatch):
    from tabloom.streaming import incremental

    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    merges, merge = [], incremental.upsert_partitions

    def counted(*args):
        merges.append(1)
        if len(merges) == 2:
            raise RuntimeError("stopped before the merge")
        merge(*args)

    monkeypatch.setattr(incremental, "upsert_partitions", counted)

    def run():
        run_incremental(stream_files(spark, src, "id int, plan string, p double", files_per_batch=1), lambda b: b, out, mark, ["id"], ["p"], 4).awaitTermination()
        return rows(spark.read.parquet(out).select("id", "plan", "p"), "id")

    for i, plan in enumerate("abc"):
        spark.createDataFrame([(1, plan, 1.0), (2 + i, plan, 1.0)], "id int, plan string, p double").coalesce(1).write.mode("append").parquet(src)
    first = run()
    assert len(merges) == 1 and [r[0] for r in first] == [1, 2, 3, 4] and first[0][1] in "abc"
    spark.createDataFrame([(1, "d", 1.0), (2, "d", 0.5)], "id int, plan string, p double").coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(RuntimeError):
        run()
    # what the stopped run took in is merged by the next one, though no file is new
    assert run() == [(1, "d", 1.0), *first[1:]] and len(merges) == 3
    assert run() == [(1, "d", 1.0), *first[1:]] and len(merges) == 3


def test_stream_replay_equals_batch(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    first = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "id int, plan string, p double")
    first.write.parquet(src)
    schema = first.schema

    def run(checkpoint):
        run_incremental(stream_files(spark, src, schema, files_per_batch=1), lambda b: b, out, checkpoint, ["id"], ["p"], 4).awaitTermination()

    run(mark)
    spark.createDataFrame([(2, "a", 5.0), (3, "b", 3.0)], schema).write.mode("append").parquet(src)
    run(mark)
    want = [(1, "a", 1.0), (2, "a", 5.0), (3, "b", 3.0)]
    assert rows(spark.read.parquet(out).select("id", "plan", "p"), "id") == want
    run(mark)  # nothing new
    assert rows(spark.read.parquet(out).select("id", "plan", "p"), "id") == want
