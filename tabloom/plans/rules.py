"""Rule text -> table: numbered steps, their yes/no branches, token lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.text import RULE_FLAGS, RULE_NUMBER_GATES, gated_number, rule_tokens

# list of tokens -> the flag that fills it
TOKEN_LISTS = {"dl": "disinfo", "dh_list": "dh", "tl": "theinfo", "manual_step_list": "manual_step"}


def steps(df: DataFrame, text: str) -> DataFrame:
    """One row per numbered step; the text before step 1 is not a step."""
    others = [c for c in df.columns if c != text]
    clean = F.replace(F.replace(F.col(text), F.lit("\n"), F.lit("")), F.lit("  "), F.lit(""))
    rows = df.select(*others, F.posexplode(F.split(clean, r"[0-9]+\.")).alias("step", "condition"))
    return rows.where(F.col("step") > 0)


def decompose(df: DataFrame, col: str) -> DataFrame:
    """condition / yes / no / if_yes / if_no of ``question? [ ] Yes … [ ] No …``."""
    at = F.split(col, r"\?", 2)
    boxes = F.split(F.try_element_at(at, F.lit(2)), r"\[ ]", 3)
    yes, no = F.try_element_at(boxes, F.lit(2)), F.try_element_at(boxes, F.lit(3))
    return df.withColumns({
        "_yes": yes, "_no": no, col: F.element_at(at, 1),
    }).withColumns({
        "if_yes": F.try_element_at(F.split("_yes", "Yes", 2), F.lit(2)),
        "if_no": F.try_element_at(F.split("_no", "No", 2), F.lit(2)),
    }).withColumnsRenamed({"_yes": "yes", "_no": "no"})


def rule_table(df: DataFrame, text: str) -> DataFrame:
    """The whole extraction: steps, branches, gated numbers, flags, tokens."""
    d = decompose(steps(df, text), "condition")
    c = F.col("condition")
    return d.withColumns({
        **{name: gated_number(c, gate) for name, gate in RULE_NUMBER_GATES.items()},
        **{name: c.contains(word) for name, word in RULE_FLAGS.items()},
        "tokens": rule_tokens(c),
    })


def flag_tokens(df: DataFrame, text: str, flags: Mapping[str, str] = TOKEN_LISTS) -> DataFrame:
    """The extraction with a token list per flag: the step's tokens where the flag is set, else null."""
    rules = rule_table(df, text)
    return rules.withColumns({name: F.when(F.col(flag), F.col("tokens")) for name, flag in flags.items()})


def token_rows(df: DataFrame, text: str, flags: Mapping[str, str] = TOKEN_LISTS) -> DataFrame:
    """One row per token of each list: the document's columns, step, list, pos, token."""
    others = [c for c in df.columns if c != text]
    found = flag_tokens(df, text, flags)
    lists = F.array(*[F.struct(F.lit(name).alias("list"), F.col(name).alias("tokens")) for name in flags])
    long = found.select(*others, "step", F.explode(lists).alias("l"))
    return long.select(*others, "step", F.col("l.list").alias("list"), F.posexplode("l.tokens").alias("pos", "token"))
