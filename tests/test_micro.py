"""Hand-made tables for the traps."""

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tabloom.functions import numeric as X
from tabloom.functions import text as S
from tabloom.operators import encoding as E
from tabloom.operators import evaluation as V
from tabloom.operators import profiling as P
from tabloom.operators import shaping
from tabloom.operators.joins import is_small, upsert_keep_last
from tabloom.operators.windows import array_differences, frequency_ranks
from tabloom.plans.claims import vote_table, vote_winners, votes_long
from tabloom.plans.rules import decompose, rule_table, steps


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_phonetic_codes(spark):
    names = ["Pfister", "Tymczak", "Honeyman", "Ashcraft", "Jacob", "Robert", "Rupert", "A", "", None]
    assert one(spark, names, S.phonetic_code) == [
        "P123", "T520", "H500", "A261", "J210", "R163", "R163", "A000", None, None]


def test_clean_categorical(spark):
    got = one(spark, ["007", "0", "0.50", " ", None, "abc", "000", "12345678", " 5 ", "1e3", "nan", "inf", "0.00001"], S.clean_categorical)
    assert got == ["7.0", "0.0", "0.5", "NA", "NA", "abc", "NA", "12345678.0", "5.0", "1000.0", "NA", "inf", "1e-05"]


@pytest.mark.parametrize("x", [0.0001, 0.00012345, 1e15, 123456789.125, 1e16, 1.5e-7, 9999999.0, 1e22, 3.0, -2.5e8])
def test_float_text_is_shortest_decimal(spark, x):
    assert one(spark, [x], S.float_text, "double") == [repr(x)]


def test_place_names(spark):
    got = one(spark, ["Orange County", "O'neil Parish", None, "  mc-donald City", "St. Mary BOROUGH"], S.standardize_place)
    assert got == ["Orange", "O'Neil", None, "Mc-Donald", "St. Mary"]


def test_rules_compose_in_order():
    assert shaping.close_rules([("a", "b"), ("b", "c")]) == {"a": "c", "b": "c"}
    assert shaping.close_rules([("b", "c"), ("a", "b")]) == {"b": "c", "a": "b"}


def test_header_collision_fails(spark):
    with pytest.raises(ValueError):
        shaping.normalize_headers(spark.createDataFrame([(1, 2)], ["A b", "a-B"]))


def test_missing_column_fails(spark):
    with pytest.raises(KeyError):
        shaping.rename_and_order(spark.range(1), {"nope": "x"}, ["id"])


def test_latest_non_null_is_per_column(spark):
    df = spark.createDataFrame([("g", 2020, 1, 5), ("g", 2021, None, 6), ("g", 2022, 3, None)], "g string, y int, a int, b int")
    assert rows(P.latest_non_null(df, ["g"], "y", ["a", "b"])) == [("g", 3, 6)]


def test_frequency_ranks(spark):
    df = spark.createDataFrame([(v,) for v in "x x x y y z w".split()] + [(None,)], "v string")
    assert dict(rows(frequency_ranks(df, "v"))) == {"x": 0, "y": 1, "z": 2, "w": 2}


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 7.0, 7.0)], "a double, b double, k double")
    got = rows(P.correlation_pairs(df))
    assert [(a, b) for a, b, _ in got] == [("a", "b")]


def test_narrowing_bounds_are_strict(spark):
    df = spark.createDataFrame([(127, 126, 1.5)], "a int, b int, c double")
    assert shaping.narrow_plan(df) == {"a": "smallint", "b": "tinyint", "c": "float"}


def test_upsert_prefers(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (3, "new")], "k int, v string")
    assert rows(upsert_keep_last(old, new, ["k"]), "k") == [(1, "new"), (2, "old"), (3, "new")]
    assert rows(upsert_keep_last(old, new, ["k"], "old"), "k") == [(1, "old"), (2, "old"), (3, "new")]


def test_votes(spark):
    cols = ["t_=_a", "t_=_b", "big_t_=_z"]
    df = spark.createDataFrame([("p", 1, 1, 0)] + [("p", 0, 0, 0)] * 4 + [("0", 1, 0, 1)], ["plan", *cols])
    wins = vote_winners(votes_long(df, "plan", "id", cols), "plan")
    # tie goes to the first column, a share of 20% is floored, suffix-alike targets stay apart
    assert rows(wins, "target") == [("p", "big_t", "z", 33.0), ("p", "t", "a", 33.0)]
    out = vote_table(wins, "plan", ["t", "big_t"], {"net_work": "x"}).first()
    assert out["field_accuracy_json"] == '{"bigT":33.0,"netWork":100.0,"t":33.0}' and out["net_work"] == "x"


def test_camel_key(spark):
    assert S.camel_key("copay_max") == "copayMax"
    assert one(spark, ["copay_max", "A_b-c", "x"], S.camel_key_col) == ["copayMax", "aBC", "x"]


def test_best_threshold_first_wins(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, p double")
    assert V.best_threshold(df, "y", "p", [0.2, 0.5, 0.8]).first()["threshold"] == 0.2
    none = spark.createDataFrame([(0, 0.1)], "y int, p double")
    assert V.best_threshold(none, "y", "p", [0.2]).first()["threshold"] == 0.5


def test_bins_and_pay(spark):
    b = one(spark, [0.0, 9.0, 10.0, 25.0, None], lambda c: X.bin_label(c, [0, 10, 20], ["a", "b"]), "double")
    assert b == ["a", "a", "b", None, None]
    assert one(spark, [5.0, 30.0, None], lambda c: X.open_bin(c, [10, 20], ["x", "y", "z"]), "double") == ["x", "z", "z"]
    assert one(spark, ["1,000.50", "bad", None], lambda c: X.yearly_amount(c, F.lit("wk"))) == [50025.0, None, None]


def test_later_rule_wins(spark):
    df = spark.range(3)
    got = df.select(X.decide([(F.col("id") > 0, "a"), (F.col("id") > 1, "b")], "z")).collect()
    assert [r[0] for r in got] == ["z", "a", "b"]


def test_array_differences(spark):
    assert one(spark, [[1.0, 4.0, 9.0], [2.0]], array_differences, "array<double>") == [[3.0, 5.0], []]


def test_rule_text(spark):
    df = spark.createDataFrame([("KT", "Title 1. Is age over 18 years of age? [ ] Yes go [ ] No deny 2. Manual step")], "drug string, txt string")
    got = rows(decompose(steps(df, "txt"), "condition").select("step", "condition", "if_yes", "if_no"), "step")
    assert got == [(1, " Is age over 18 years of age", " go ", " deny "), (2, " Manual step", None, None)]
    full = rule_table(df, "txt").orderBy("step").collect()
    assert full[0]["age"] == "18" and full[1]["age"] is None and full[1]["manual_step"] is True
    assert full[1]["tokens"] == []


def test_encode_decode_is_identity(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "v string")
    codes = E.label_codes(df, "v")
    enc = E.label_encode(df.where("v <> 'c'").union(spark.createDataFrame([("new",)], "v string")), "v", codes, "code")
    assert sorted(rows(enc.select("v", "code"))) == [("a", 0), ("a", 0), ("b", 1), ("new", -1)]
    back = E.label_decode(enc.select("code"), "code", codes, "v")
    assert sorted(r["v"] or "" for r in back.collect()) == ["", "a", "a", "b"]


def test_dummies_align(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    d = E.align_columns(E.dummies(df, {"c": ["x", "y"]}), ["c_=_x", "c_=_z"])
    assert rows(d) == [(1, 0), (0, 0)]


def test_identical_columns(spark):
    df = spark.createDataFrame([(1, 1, 2, 1), (2, 2, 1, 2), (3, 3, 3, None)], "a int, b int, c int, d int")
    assert shaping.identical_columns(df) == [("a", "b")]


def test_wide_correlations_use_pairwise_rows(spark):
    data = [(float(i), float(i * i % 7), None if i % 2 else float(i % 5)) for i in range(20)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    wide = df.withColumns({f"x{i:02d}": F.col("a") * (i + 1) + F.col("b") for i in range(45)})
    few = {(r["a"], r["b"]): r["r"] for r in P.correlation_pairs(df).collect()}
    many = {(r["a"], r["b"]): r["r"] for r in P.correlation_pairs(wide).collect()}
    assert len(many) == 48 * 47 // 2
    assert all(many[k] == pytest.approx(v) for k, v in few.items())


def test_describe_keeps_null_columns_and_groups(spark):
    df = spark.createDataFrame([("g", 1.0, None), (None, 3.0, None), (None, 5.0, None)], "k string, v double, w double")
    whole = {r["variable"]: r for r in P.describe(df, ["v", "w"]).collect()}
    assert (whole["w"]["n_values"], whole["w"]["missing"], whole["w"]["mean"]) == (0, 3, None)
    assert whole["v"]["p50"] == 3.0
    groups = {(r["k"], r["variable"]): r for r in P.describe(df, ["v", "w"], ["k"]).collect()}
    assert groups[None, "v"]["p50"] == 4.0 and groups[None, "w"]["n_values"] == 0 and len(groups) == 4


def test_manifest_counts_row_pairs(spark):
    from tabloom.sources.writers import row_manifest

    digest = lambda values: row_manifest(spark.createDataFrame([(v,) for v in values], "x int")).first()["digest"]
    assert digest([1, 1, 2]) != digest([9, 9, 2]) and digest([1, 2, 1]) == digest([2, 1, 1])


def test_late_event_does_not_replace_a_newer_one(spark, tmp_path):
    from tabloom.streaming.incremental import upsert_partitions

    path = str(tmp_path / "detail")
    for batch in ([(1, 10, "new")], [(1, 5, "late"), (2, 1, "other")], [(2, 1, "again")]):
        upsert_partitions(spark.createDataFrame(batch, "id int, ts int, v string"), path, ["id"], ["ts"], 4)
    assert {(r["id"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "new"), (2, "again")}


def test_weights_of_null_labels_are_null(spark):
    from tabloom.operators.models import balanced_weights

    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "label string")
    got = {r["label"]: r["weight"] for r in balanced_weights(df, "label").collect()}
    assert got == {"a": pytest.approx(4 / 6), "b": 2.0, None: None}


def test_assembled_vectors_keep_every_row(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, float("nan"), 4), (3, 1.0, 5)], "id int, a double, b int")
    got = {r["id"]: r["features"].toArray().tolist() for r in E.assemble(df, ["a", "b"]).collect()}
    assert got == {1: [2.0, 0.0], 2: [0.0, 4.0], 3: [1.0, 5.0]}
    scores, explained, k = E.principal_components(df, ["a", "b"], k=2)
    assert scores.count() == 3 and k == 2


def test_a_column_that_tells_groups_apart_is_best(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 2), float(i), float(i % 3)) for i in range(30)], "label double, same double, up double, other double")
    assert E.k_best(df, "label", ["other", "up", "same"], 1) == ["same"]


def test_small_by_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 3, "v string")
    assert is_small(df) and not is_small(df, rows=2) and not is_small(df, size=2000)


def test_modes_of_any_type_in_one_scan(spark):
    import datetime as dt
    from decimal import Decimal

    day = dt.date(2024, 1, 5)
    data = [("g", "b", 10, 2.5, Decimal("1.50"), day, True, None), ("g", "a", 9, 2.5, Decimal("10.00"), day, False, None),
            ("g", "b", 10, -1.0, Decimal("9.00"), None, False, None), ("g", "a", 9, None, Decimal("9.00"), dt.date(2023, 1, 1), None, None),
            (None, "z", None, None, None, None, None, None), (None, "z", 3, None, None, None, None, None)]
    df = spark.createDataFrame(data, "k string, s string, i int, d double, m decimal(10,2), t date, b boolean, e float")
    cols = ["s", "i", "d", "m", "t", "b", "e"]
    got = {r["k"]: tuple(r)[1:] for r in P.mode_per_group(df, cols, ["k"]).collect()}
    assert got == {"g": ("a", 9, 2.5, Decimal("9.00"), day, False, None), None: ("z", 3, None, None, None, None, None)}
    out = P.mode_per_group(df, cols, ["k"])
    assert [f.dataType for f in out.schema] == [df.schema[c].dataType for c in ["k", *cols]]
    assert tuple(P.mode_per_group(df, ["s", "i"]).first()) == ("a", 9)
    assert [tuple(r) for r in P.mode_per_group(df.limit(0), ["s", "i"]).collect()] == [(None, None)]
    assert P.mode_per_group(df.limit(0), ["s"], ["k"]).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan") <= 1
