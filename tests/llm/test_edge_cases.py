"""Very long texts, repeated rows, clashing columns and empty tables, operator by operator and through the pipeline."""

import random

import pytest

import corpus_pipeline
from tabloom.llm import exact_dedup, license_scan, line_dedup, ngram_join, packing, quality, sentencepiece_codec, toxicity, url_filter
from tests.llm.test_dedup import components_by_force, removed_by_force


@pytest.fixture(scope="module")
def long_rows():
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("a", "en", "ist", "ohr", "über")]
    prose = " ".join(rng.choice(words) for _ in range(60_000))
    near = prose.split(" ")
    near[::97] = ["changed"] * len(near[::97])
    lines = "\n".join(" ".join(rng.choice(words) for _ in range(5)) for _ in range(6000))
    return [(1, prose), (2, " ".join(near)), (3, prose[:200_000]), (4, lines), (5, lines + "\nand one more line of its own, at the end"),
            (6, "x" * 300_000), (6, "x" * 300_000), (7, "\n" * 5000), (8, None)]


def test_long_texts_keep_their_links(docs, long_rows):
    rows = [(i, t) for i, t in long_rows if i != 6]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(*rows)).collect()}
    assert found == components_by_force(rows)


def test_long_texts_lose_their_repeated_lines(docs, long_rows):
    rows = [(i, t) for i, t in long_rows if i in (4, 5, 7, 8)]
    got = {r.doc_id: (r.n_lines, r.lines_removed) for r in line_dedup.dedup_lines(docs(*rows)).collect()}
    # all of 4 comes again in 5, which keeps its own line; lines without words are no run of ten words
    assert got == {4: (6000, 0), 5: (6001, 6000), 7: (5001, 0), 8: (0, 0)}
    small = [(i, "\n".join(t.split("\n")[:40])) for i, t in rows if t] + [(9, "\n".join(rows[0][1].split("\n")[10:30]))]
    gone = removed_by_force(small, 10)
    assert {r.doc_id: r.lines_removed for r in line_dedup.dedup_lines(docs(*small)).collect()} == {
        i: sum(d == i for d, _ in gone) for i, _ in small}


def test_long_and_repeated_rows_elsewhere(docs, long_rows):
    df = docs(*long_rows)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(df).collect()} >= {(6, 6, 2), (1, 1, 1)}
    judged = quality.judge(df).collect()
    assert len(judged) == 9 and {r.n_words for r in judged if r.doc_id == 6} == {1}
    packed = packing.pack(df).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in long_rows}
    assert sorted(r.doc_tokens for r in packed if r.start == 0 and r.doc_id in (7, 8))[0] == 1
    some = docs(*[r for r in long_rows if r[0] in (3, 7, 8)], (3, "ab cd"))
    coded = sentencepiece_codec.encode(some).collect()
    assert len(coded) == 4 and all(r.round_trip for r in coded)


def test_clashing_columns_are_ignored(spark, docs):
    odd = spark.createDataFrame([(1, "http://a.com/de/1", None, 5, "x", "y"), (1, "http://a.com/de/1", None, 5, "x", "y")],
                                "page_id long, url string, html string, host int, rule string, component string")
    assert [(r.host, r.rule, r.verdict) for r in url_filter.judge(odd).collect()] == [("a.com", "com/de/", "block")] * 2
    files = spark.createDataFrame([(1, "a/x", "Released under the MIT License.", "q", 3), (1, "a/x", "Released under the MIT License.", "q", 3),
                                   (2, "a/y", "", "q", 3)], "doc_id long, path string, text string, dir string, line int")
    assert [(r.doc_id, r.license) for r in license_scan.scan(files).orderBy("doc_id").collect()] == [(1, "MIT")] * 2 + [(2, "MIT")]


def test_pipeline_of_little_or_nothing(spark, docs, tmp_path):
    rng = random.Random(2)
    common = "the of and to in was that with for on as by at from".split()

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices("abcdefghij", k=6)) for _ in range(n)) + "."

    same = prose(80)
    rows = [(i, prose(60)) for i in range(60)] + [(100, same), (101, same), (102, None), (103, ""), (100, same)]
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, made in (("none", docs(*rows).limit(0)), ("some", docs(*rows))):
        folder = str(tmp_path / name)
        made.write.parquet(f"{folder}/documents.parquet")
        empty.write.parquet(f"{folder}/labels.parquet")
        left = made
        for stage, run in corpus_pipeline.STAGES[:-1]:
            out = run(spark, left, folder)
            assert out.columns == made.columns, stage
            where = f"{folder}/{stage}"
            out.write.parquet(where)
            left = spark.read.parquet(where)
        packed = corpus_pipeline.run(spark, folder)
        kept = {r.doc_id for r in packed.select("doc_id").collect()}
        assert kept == {r.doc_id for r in left.select("doc_id").collect()}
        # no labels, no verdicts on toxicity; empty texts fail the quality rules; one of the equal texts stays
        assert kept == (set() if name == "none" else {*range(60), 100})
    assert toxicity.judge(docs(*rows), empty).filter("rejected").count() == 0
