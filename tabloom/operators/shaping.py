"""Projection and schema shaping: every operator is one ``select``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Signed ranges used when narrowing (strictly inside).
_INT_RANGES = (("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -(2**31), 2**31 - 1))
_FLOAT_MAX = 3.4028234663852886e38


def header_name(name: str, style: str = "basic") -> str:
    if style == "basic":
        for mark in (" ", "-", "/"):
            name = name.replace(mark, "_")
        return name.replace(",", "").lower()
    if style == "strict":
        name = re.sub(r"[/.&\-\s(),%#+=\[\]]+", "_", name.lower())
        return re.sub(r"_+", "_", name).strip("_")
    if style == "formula":
        return name.replace(" ", "_").replace("%", "pct").replace("-", "_")
    raise ValueError(f"unknown header style {style!r}")


def normalize_headers(df: DataFrame, style: str = "basic") -> DataFrame:
    names = [header_name(c, style) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"headers collide after normalisation: {clash}")
    return df.toDF(*names)


def map_columns(df: DataFrame, mapping: DataFrame, client: str) -> DataFrame:
    """Select and rename by a mapping table filtered to one client: a row for
    each column of the result."""
    own = mapping.where(F.col("client_code") == client)
    rows = own.select("prediction_column_name", "training_column_name").distinct().collect()
    pairs = {r[0]: r[1] for r in rows}
    return df.select(*[F.col(f"`{p}`").alias(t) for p, t in sorted(pairs.items())])


def add_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def cast_all(df: DataFrame, dtype: str = "string") -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast(dtype).alias(c) for c in df.columns])


def trim_all(df: DataFrame) -> DataFrame:
    text = set(names_by_type(df)[1])
    return df.select(*[F.trim(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def drop_matching(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if not any(re.search(p, c) for p in patterns)])


def identical_columns(df: DataFrame, key: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """(kept, dropped) pairs of same-type columns with equal content.

    One aggregate gives each column an order-free fingerprint, a second one
    proves each candidate pair row by row; only one row per pass is collected.
    """
    cols = df.columns
    row_key = [F.col(k) for k in (key or cols)]
    prints = df.agg(
        *[F.bit_xor(F.xxhash64(*row_key, F.col(c))).alias(f"h{i}") for i, c in enumerate(cols)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
    ).first()
    groups: dict[tuple, list[str]] = {}
    for i, c in enumerate(cols):
        groups.setdefault((df.schema[c].dataType.simpleString(), prints[f"h{i}"], prints[f"n{i}"]), []).append(c)
    pairs = [(a, b) for g in groups.values() for i, a in enumerate(g) for b in g[i + 1:]]
    if not pairs:
        return []
    proof = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    equal = [p for p, ok in zip(pairs, proof.first(), strict=True) if ok]
    dropped: set[str] = set()
    out = []
    for a, b in equal:
        if a not in dropped and b not in dropped:
            out.append((a, b))
            dropped.add(b)
    return out


def drop_identical_columns(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*[b for _, b in identical_columns(df, key)])


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    names = df.columns
    keep = [i for i, n in enumerate(names) if n not in names[:i]]
    tagged = df.toDF(*[f"_{i}" for i in range(len(names))])
    return tagged.select(*[F.col(f"_{i}").alias(names[i]) for i in keep])


def select_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    have = [c for c in wanted if c in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    return df.select(*have), have, missing


def names_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names from the schema alone."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return numeric, text


def coalesce_columns(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in cols])).drop(*[c for c in cols if c != out])


def narrow_plan(df: DataFrame) -> dict[str, str]:
    """Smallest type per numeric column from one min/max aggregate."""
    numeric = names_by_type(df)[0]
    aggs = [f(c).alias(f"{n}_{i}") for i, c in enumerate(numeric) for n, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    plan = {}
    for i, c in enumerate(numeric):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        if lo is None:
            continue
        if isinstance(df.schema[c].dataType, T.IntegralType):
            fit = [t for t, a, b in _INT_RANGES if a < lo and hi < b]
            plan[c] = fit[0] if fit else "bigint"
        elif isinstance(df.schema[c].dataType, T.FractionalType) and not isinstance(
            df.schema[c].dataType, T.DecimalType
        ):
            plan[c] = "float" if -_FLOAT_MAX < lo and hi < _FLOAT_MAX else "double"
    return plan


def narrow_types(df: DataFrame) -> DataFrame:
    plan = narrow_plan(df)
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])


def to_numeric(df: DataFrame, cols: Sequence[str], fill: float | None = None, dtype: str = "double") -> DataFrame:
    def conv(c: str) -> Column:
        v = F.col(c).try_cast(dtype)
        return v if fill is None else F.coalesce(v, F.lit(fill).cast(dtype))

    return df.withColumns({c: conv(c) for c in cols})


def promote_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def rename_and_order(df: DataFrame, renames: Mapping[str, str], final: Sequence[str]) -> DataFrame:
    """Explicit renames, then a fixed projection; a missing column is an error."""
    missing = [c for c in renames if c not in df.columns]
    names = [renames.get(c, c) for c in df.columns]
    missing += [c for c in final if c not in names]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    back = {new: old for old, new in zip(df.columns, names, strict=True)}
    return df.select(*[F.col(f"`{back[c]}`").alias(c) for c in final])


# -- recoding -----------------------------------------------------------------


def close_rules(rules: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Ordered literal replacements as one map: a target rewritten by a later
    rule carries through (a->b then b->c gives a->c)."""
    closed: dict[str, str] = {}
    for old, new in rules:
        for k, v in closed.items():
            if v == old:
                closed[k] = new
        closed.setdefault(old, new)
    return closed


def recode(df: DataFrame, rules: Sequence[tuple[str, str, str]], cols: Sequence[str]) -> DataFrame:
    """``rules`` are ordered (column or ``*``, from, to); one lookup per column."""
    out = {}
    for c in cols:
        mapping = close_rules([(a, b) for target, a, b in rules if target in (c, "*")])
        if mapping:
            table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
            out[c] = F.coalesce(F.try_element_at(table, F.col(c)), F.col(c))
    return df.withColumns(out) if out else df


def fill_model_inputs(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Shared by training and scoring: '' -> Blank, null -> UNK, numerics -> 0."""
    cat = {c: F.coalesce(F.when(F.col(c) == "", "Blank").otherwise(F.col(c)), F.lit("UNK")) for c in categorical}
    num = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in numeric}
    return df.withColumns({**cat, **num})


def derived_columns(
    df: DataFrame,
    sums: Mapping[str, Sequence[str]] | None = None,
    squares: Sequence[str] = (),
    products: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    out: dict[str, Column] = {}
    for name, cols in (sums or {}).items():
        total = F.col(cols[0])
        for c in cols[1:]:
            total = total + F.col(c)
        out[name] = total
    out.update({f"{c}_squared": F.col(c) * F.col(c) for c in squares})
    out.update({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in products})
    return df.withColumns(out)
