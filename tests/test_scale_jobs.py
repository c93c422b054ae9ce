"""Steps that one task or the driver used to do alone, or again and again."""

import glob
import hashlib
import os
import re

from pyspark.sql import functions as F

from tabloom.catalog import base, sources
from tabloom.plans import research


def test_pages_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    base.load_all()
    spark.range(60).select(F.col("id").alias("page_id"), F.concat(F.lit("<p>"), F.col("id").cast("string")).alias("html")).coalesce(1).write.parquet(
        str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(sources, "scratch_path", lambda *_: str(tmp_path / "out"))
    got = {r["page_id"]: r["size"] for r in base.QUERIES["a07_read_corpus"](spark, str(tmp_path)).collect()}
    assert got == {i: 4 + len(str(i)) for i in range(60)}
    files = glob.glob(str(tmp_path / "out" / "*" / "*.txt"))
    assert len(files) == 60
    assert len({re.match(r"part-(\d+)", os.path.basename(f)).group(1) for f in files}) > 1


def test_pages_share_folders_and_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    base.load_all()
    rows = [(i, f"<p>{i}é") for i in range(200)] + [(200, None), (201, ""), (202, "a\r\nb\n"), (7, "<p>7é"), (200, "x")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(sources, "scratch_path", lambda *_: str(tmp_path / "out"))
    found = base.QUERIES["a07_read_corpus"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < 203
    want = {i: f"<p>{i}é\n".encode() for i in range(200)} | {201: b"\n", 202: b"a\r\nb\n\n", 7: "<p>7é\n<p>7é\n".encode()}
    got = {r["page_id"]: (r["size"], r["digest"]) for r in found.collect()}
    assert got.pop(200) in [(3, hashlib.md5(x).hexdigest()) for x in (b"\nx\n", b"x\n\n")]
    assert got == {i: (len(x), hashlib.md5(x).hexdigest()) for i, x in want.items()}
    # before: a folder for each page, and a checksum file
    assert len(os.listdir(tmp_path / "out")) <= 2 * spark.sparkContext.defaultParallelism
    assert sum(len(files) for _, _, files in os.walk(tmp_path / "out")) == 203


def test_no_pages_make_an_empty_corpus(spark, tmp_path):
    base.load_all()
    spark.createDataFrame([], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert base.QUERIES["a07_read_corpus"](spark, str(tmp_path)).collect() == []


def test_a_ladder_of_fits_works_its_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.createDataFrame([(i % 7, float(i % 5), float(i % 11), float(i * i % 13 + i % 7)) for i in range(400)],
                                 "g int, a double, b double, y double").mapInPandas(count, "g int, a double, b double, y double")
    fits = research.fit_ladder(rows, "y", "g", ["a"], ["b"])
    assert list(fits) == ["null", "level1", "level2"] and {f.n for f in fits.values()} == {400}
    assert seen.value <= 800  # a checkpoint reads them at most twice; before: six times


def test_targets_hash_keys_once_and_hold_what_their_fits_read(spark, tmp_path, monkeypatch):
    from tabloom.operators import sets
    from tabloom.plans import targets

    rows = [(f"c{i}", i % 7, float(i % 5), i % 3, int(i % 7 <= 3), int(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows + [(None, 1, 1.0, 1, 1, 0)], "id string, a int, b double, c int, `x_=_1` int, `x_=_2` int")
    hashed, judged = [], []
    plain, metrics = sets.hash_order, targets.binary_metrics
    monkeypatch.setattr(sets, "hash_order", lambda c: hashed.append(c) or plain(c))

    def seen(scored, label, pred):
        judged.append(scored.columns)
        return metrics(scored, label, pred)

    monkeypatch.setattr(targets, "binary_metrics", seen)
    saved = targets.train_targets(df, ["x_=_1", "x_=_2"], ["a", "b", "c"], "id", str(tmp_path), k=1, trees=2, rounds=2).collect()
    assert {r["target"]: r["features"] for r in saved} == {"x_=_1": "a", "x_=_2": "b"}
    assert all(r["precision"] == 1.0 for r in saved)
    assert not hashed  # one hash for all targets, none in their splits
    assert len(judged) == 6 and not any({"id", "c", "part"} & set(columns) for columns in judged)


def test_a_split_by_hashed_keys_is_the_split_by_keys(spark):
    from tabloom.functions.numeric import hash_order
    from tabloom.operators.sets import stratified_split

    df = spark.createDataFrame([(k, i % 3 if i % 11 else None) for i, k in enumerate([*range(300), *range(40), None, None])],
                               "k int, g int")
    df = df.withColumn("h", hash_order(F.col("k")))
    a = stratified_split(df, "g", "k", 0.25).orderBy("g", "k", "part").collect()
    assert a == stratified_split(df, "g", "h", 0.25, hashed=True).orderBy("g", "k", "part").collect()
    assert {r["part"] for r in a} == {"train", "test"}
