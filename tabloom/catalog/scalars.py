"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import DIRTY_EVENTS, SCORED, Tables, as_int, dirty_events, query, rd, scored
from tabloom.catalog.joins import _CODE, _TOKENS, tokens
from tabloom.functions import numeric as X
from tabloom.functions import text as S
from tabloom.operators import shaping

from tabloom.operators.joins import decode_labels
from tabloom.operators.windows import group_count
from tabloom.plans.rules import token_rows


@query("i01_recode", """
select p_partkey, case when p_type in ('ECONOMY', 'SMALL') then 'COMPACT' when p_type = 'MEDIUM' then 'MID' else p_type end as p_type,
  case when p_brand in ('Brand#1', 'Brand#2') then 'House' when p_brand = 'Brand#3' then 'Third' else p_brand end as p_brand from part""")
def i01(t: Tables):
    rules = [("p_type", "ECONOMY", "SMALL"), ("p_type", "MEDIUM", "MID"), ("*", "SMALL", "COMPACT"),
             ("p_brand", "Brand#1", "Brand#2"), ("p_brand", "Brand#2", "House"), ("p_brand", "Brand#3", "Third")]
    return shaping.recode(t.part, rules, ["p_type", "p_brand"]).select("p_partkey", "p_type", "p_brand")


@query("i02_clean_categorical", f"""
with b as (select event_id, case when etype is null or trim(etype) = '' then 'NA' else trim(etype) end as e,
  case when length(amount_text) > 1 and amount_text not like '%0.%' then ltrim(amount_text, '0') else amount_text end as a from {DIRTY_EVENTS})
select event_id, e as etype, case when a = '' then 'NA' when try_cast(a as double) is not null then cast(cast(a as double) as varchar)
  else a end as amount_text from b""")
def i02(t: Tables):
    return dirty_events(t).select("event_id", S.clean_categorical(F.col("etype")).alias("etype"),
                                  S.clean_categorical(F.col("amount_text")).alias("amount_text"))


@query("i03_fill_model_inputs", f"""
select event_id, case when b.etype is null then 'UNK' when b.etype = '' then 'Blank' else b.etype end as etype,
  coalesce(try_cast(amount_text as double), 0.0) as amount_text
from (select event_id, trim(etype) as etype, amount_text from {DIRTY_EVENTS}) b""")
def i03(t: Tables):
    d = dirty_events(t).select("event_id", F.trim("etype").alias("etype"), "amount_text")
    return shaping.fill_model_inputs(d, ["etype"], ["amount_text"])


@query("i04_phonetic_code", f"select w, {_CODE} as code from {_TOKENS}")
def i04(t: Tables):
    return tokens(t).select("w", S.phonetic_code(F.col("w")).alias("code"))


_PLACE = """(select c_custkey, case when c_custkey % 17 = 0 then null else c_mktsegment || case c_custkey % 6 when 0 then ' County'
  when 1 then ' Parish' when 2 then ' borough' when 3 then ' CITY' when 4 then ' City  ' else '' end end as place from customer)"""


def places(t: Tables):
    k = F.col("c_custkey") % 6
    suffix = F.when(k == 0, " County").when(k == 1, " Parish").when(k == 2, " borough").when(k == 3, " CITY").when(
        k == 4, " City  ").otherwise("")
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 17 != 0, F.concat("c_mktsegment", suffix)).alias("place"))


@query("i06_standardize_place", f"""
select c_custkey, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace(regexp_replace(trim(place), '\\s+County$', ''), '\\s+Parish$', ''), '\\s+Borough$', ''), '\\s+city$', ''),
 '\\s+City$', ''), '\\s+COUNTY$', ''), '\\s+PARISH$', ''), '\\s+BOROUGH$', ''))) as place_key,
 replace(replace(replace(upper(trim(place)), ' COUNTY', ''), ' PARISH', ''), ' BOROUGH', '') as place_upper from {_PLACE}""")
def i06(t: Tables):
    p = F.col("place")
    return places(t).select("c_custkey", F.lower(S.standardize_place(p)).alias("place_key"),
                            S.standardize_place_upper(p).alias("place_upper"))


@query("i07_categorize", f"""
select c_custkey, case when place is null then 'Unknown' when upper(place) like '%BUILD%' or upper(place) like '%MACHIN%' then 'Industry'
  when upper(place) like '%HOUSE%' then 'Home' else 'Other' end as kind from {_PLACE}""")
def i07(t: Tables):
    rules = [(["BUILD", "MACHIN"], "Industry"), (["HOUSE"], "Home")]
    return places(t).select("c_custkey", S.categorize(F.col("place"), rules, "Other", "Unknown").alias("kind"))


@query("i08_yes_no", """
select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 0 end as has_service from orders""")
def i08(t: Tables):
    word = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").otherwise("maybe")
    return t.orders.select("o_orderkey", S.yes_no(word).alias("has_service"))


@query("i09_tolerant_int", f"select event_id, try_cast(amount_text as integer) as rating from {DIRTY_EVENTS}")
def i09(t: Tables):
    return dirty_events(t).select("event_id", S.tolerant_int(F.col("amount_text")).alias("rating"))


@query("i10_composite_key", f"select event_id, etype || '_' || cast(user_id as varchar) as k from {DIRTY_EVENTS}")
def i10(t: Tables):
    return dirty_events(t).select("event_id", S.composite_key(F.col("etype"), F.col("user_id")).alias("k"))


_TITLE = """(select p_partkey, case p_partkey % 5 when 0 then 'Sr. ' || p_type || ' Engineer - ' || p_brand when 1 then p_type || ' Analyst II'
  when 2 then ' ' || p_type || '/' || p_brand when 3 then 'nan' else p_type || ' III lead' end as title from part)"""


@query("i11_normalize_title", f"""
select p_partkey, case when x in ('nan', 'nat') then null else x end as title from (
 select p_partkey, regexp_replace(trim(split_part(split_part(split_part(lower(title), '-', 1), 'ii', 1), '/', 1)), 'sr.', 'senior', 'g') as x
 from {_TITLE})""")
def i11(t: Tables):
    k, ty, br = F.col("p_partkey") % 5, F.col("p_type"), F.col("p_brand")
    title = F.when(k == 0, F.concat(F.lit("Sr. "), ty, F.lit(" Engineer - "), br)).when(k == 1, F.concat(ty, F.lit(" Analyst II"))).when(
        k == 2, F.concat(F.lit(" "), ty, F.lit("/"), br)).when(k == 3, "nan").otherwise(F.concat(ty, F.lit(" III lead")))
    return t.part.select("p_partkey", S.normalize_title(title).alias("title"))


_WAGE = """(select o_orderkey, case when o_orderkey % 19 = 0 then null else format('{:,}', cast(floor(o_totalprice) as bigint)) end as amt,
  case o_orderkey % 5 when 0 then 'hr' when 1 then 'Week' when 2 then 'mth' when 3 then 'Bi-Weekly' else 'yr' end as unit from orders)"""
_YEARLY = f"""(select o_orderkey, unit, cast(replace(amt, ',', '') as double) * case unit when 'hr' then 2000 when 'Week' then 50
  when 'mth' then 12 when 'Bi-Weekly' then 25 else 1 end as y from {_WAGE})"""


def wages(t: Tables):
    k = F.col("o_orderkey") % 5
    unit = F.when(k == 0, "hr").when(k == 1, "Week").when(k == 2, "mth").when(k == 3, "Bi-Weekly").otherwise("yr")
    amount = F.when(F.col("o_orderkey") % 19 != 0, F.format_number(F.floor("o_totalprice"), 0))
    return t.orders.select("o_orderkey", amount.alias("amt"), unit.alias("unit"))


@query("i12_yearly_wage", f"""
select o_orderkey, 'Year' as unit, round(coalesce(y, (select median(y) from {_YEARLY})), 2) as yearly from {_YEARLY}""")
def i12(t: Tables):
    from tabloom.operators.encoding import fill_statistic

    w = wages(t).select("o_orderkey", X.yearly_unit(F.col("unit")).alias("unit"),
                        X.yearly_amount(F.col("amt"), F.col("unit")).alias("yearly"))
    return fill_statistic(w, ["yearly"], "median").withColumn("yearly", rd("yearly", 2))


@query("i13_year", "select o_orderkey, cast(year(o_orderdate) as integer) as order_year from orders")
def i13(t: Tables):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))


@query("i14_bins", """
select o_orderkey, case when o_totalprice >= 0 and o_totalprice < 100000 then '0-100k' when o_totalprice >= 100000 and o_totalprice < 300000
  then '100-300k' when o_totalprice >= 300000 and o_totalprice < 450000 then '300-450k' end as band,
  case when o_totalprice < 100000 then '<100k' when o_totalprice < 200000 then '100-200k' else '200k+' end as open_band from orders""")
def i14(t: Tables):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", X.bin_label(p, [0, 100_000, 300_000, 450_000], ["0-100k", "100-300k", "300-450k"]).alias("band"),
                           X.open_bin(p, [100_000, 200_000], ["<100k", "100-200k", "200k+"]).alias("open_band"))


@query("i15_power_transforms", """
select o_orderkey, round(ln(1 + o_totalprice), 8) as l1, round(ln(o_totalprice), 8) as l0,
  round((pow(1 + o_totalprice, 0.15) - 1) / 0.15, 6) as bc from orders""")
def i15(t: Tables):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", rd(F.log1p(p), 8).alias("l1"), rd(F.log(p), 8).alias("l0"), rd(X.boxcox1p(p)).alias("bc"))


_PERSON = """(select c_custkey, c_mktsegment || ', ' || case c_custkey % 7 when 0 then 'Mr' when 1 then 'Mlle' when 2 then 'Capt' when 3 then 'Dona'
  when 4 then 'Mme' when 5 then 'Lady' else 'Mrs' end || '. ' || c_name as name, c_custkey % 4 as sib, c_nationkey % 3 as par from customer)"""
_FAMILY = f"""(select c_custkey, sib + par + 1 as size, case when sib + par + 1 <= 2 then 'Small'
  else cast(sib + par + 1 as varchar) || split_part(name, ',', 1) end as fid from {_PERSON})"""


@query("i16_person_names", f"""
with f as (select * from {_FAMILY}), n as (select fid, count(*) as n from f group by fid),
ti as (select c_custkey, ltrim(split_part(split_part(name, ',', 2), '.', 1), ' ') as ti from {_PERSON})
select c_custkey, case when ti in ('Mlle', 'Mme') then 'Mme' when ti in ('Capt', 'Don', 'Major', 'Sir') then 'Sir'
  when ti in ('Dona', 'Lady', 'the Countess', 'Jonkheer') then 'Lady' else ti end as title, cast(size as bigint) as family_size,
  case when n <= 130 then 'Small' else f.fid end as family_id from f join n using (fid) join ti using (c_custkey)""")
def i16(t: Tables):
    k = F.col("c_custkey") % 7
    ti = F.when(k == 0, "Mr").when(k == 1, "Mlle").when(k == 2, "Capt").when(k == 3, "Dona").when(k == 4, "Mme").when(
        k == 5, "Lady").otherwise("Mrs")
    p = t.customer.select("c_custkey", F.concat(F.col("c_mktsegment"), F.lit(", "), ti, F.lit(". "), F.col("c_name")).alias("name"),
                          (F.col("c_custkey") % 4 + F.col("c_nationkey") % 3 + 1).alias("family_size"))
    # Title groups and the label each takes.
    groups = [(("Mlle", "Mme"), "Mme"), (("Capt", "Don", "Major", "Sir"), "Sir"),
              (("Dona", "Lady", "the Countess", "Jonkheer"), "Lady")]
    fid = F.when(F.col("family_size") <= 2, "Small").otherwise(
        F.concat(F.col("family_size").cast("string"), S.surname(F.col("name"))))
    d = group_count(p.select("c_custkey", "family_size", S.person_title(F.col("name"), groups).alias("title"),
                             fid.alias("family_id")), ["family_id"], "_n")
    return d.select("c_custkey", "title", "family_size",
                    F.when(F.col("_n") <= 130, "Small").otherwise(F.col("family_id")).alias("family_id"))


@query("i17_pii_hash", f"select event_id, coalesce(to_base64(unhex(sha256(etype))), '') as h from {DIRTY_EVENTS}")
def i17(t: Tables):
    return dirty_events(t).select("event_id", S.pii_hash(F.col("etype")).alias("h"))


_RULE = """(select p_partkey, p_type || ' rules 1. Is the client ' || p_size || ' years of age? [ ] Yes go to 2 [ ] No deny 2. Has ' || p_name
  || ' been tried for ' || (p_size * 2) || ' days? [ ] Yes approve [ ] No go to 3 3. Manual review of the dose inj' as txt from part)"""


def rule_text(t: Tables):
    size = F.col("p_size")
    return t.part.select("p_partkey", F.concat(
        F.col("p_type"), F.lit(" rules 1. Is the client "), size.cast("string"),
        F.lit(" years of age? [ ] Yes go to 2 [ ] No deny 2. Has "), F.col("p_name"), F.lit(" been tried for "),
        (size * 2).cast("string"), F.lit(" days? [ ] Yes approve [ ] No go to 3 3. Manual review of the dose inj")).alias("txt"))


def rule_steps(t: Tables):
    from tabloom.plans.rules import decompose, steps

    return decompose(steps(rule_text(t), "txt"), "condition")


_STEPS = f"""(select p_partkey, step, split_part(body, '?', 1) as condition, case when contains(body, '?') then substr(body, strpos(body, '?') + 1) end as yn
  from (select p_partkey, generate_subscripts(a, 1) - 1 as step, unnest(a) as body from (
    select p_partkey, regexp_split_to_array(txt, '[0-9]+\\.') as a from {_RULE})) where step > 0)"""


@query("i18_gated_numbers", f"""
select p_partkey, cast(step as integer) as step,
  case when contains(condition, 'years of age') then nullif(regexp_extract(condition, '(\\d+)', 1), '') end as age,
  case when contains(condition, 'days') then nullif(regexp_extract(condition, '(\\d+)', 1), '') end as no_of_days,
  case when contains(condition, 'dose') then nullif(regexp_extract(condition, '(\\d+)', 1), '') end as mg_per_day,
  cast(contains(condition, 'inj') as integer) as contains_inj, cast(contains(condition, 'Manual') as integer) as manual_step from {_STEPS}""")
def i18(t: Tables):
    c = F.col("condition")
    return rule_steps(t).select(
        "p_partkey", "step", *[S.gated_number(c, S.RULE_NUMBER_GATES[g]).alias(g) for g in ("age", "no_of_days", "mg_per_day")],
        *[as_int(c.contains(S.RULE_FLAGS[f])).alias(f) for f in ("contains_inj", "manual_step")])


@query("i19_split_steps", f"""
select p_partkey, cast(step as integer) as step, condition, string_split(yn, '[ ]')[2] as yes, string_split(yn, '[ ]')[3] as no,
  string_split(string_split(yn, '[ ]')[2], 'Yes')[2] as if_yes, string_split(string_split(yn, '[ ]')[3], 'No')[2] as if_no from {_STEPS}""")
def i19(t: Tables):
    return rule_steps(t).select("p_partkey", "step", "condition", "yes", "no", "if_yes", "if_no")


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in S.RULE_STOP_WORDS)


@query("i20_rule_tokens", f"""
select p_partkey, cast(step as integer) as step, tok from (select p_partkey, step, unnest(regexp_split_to_array(trim(condition), '\\s+')) as tok
  from {_STEPS}) where tok <> '' and tok not in ({_STOP})""")
def i20(t: Tables):
    return rule_steps(t).select("p_partkey", "step", F.explode(S.rule_tokens(F.col("condition"))).alias("tok"))


_LISTS = {"dl": "dig", "dh_list": "hist", "tl": "thp", "manual_step_list": "Manual"}


@query("i20_flag_tokens", " union all ".join(f"""
select p_partkey, step, '{name}' as list, cast(row_number() over (partition by p_partkey, step order by i) - 1 as integer) as pos, tok as token
from (select p_partkey, cast(step as integer) as step, condition, generate_subscripts(regexp_split_to_array(trim(condition), '\\s+'), 1) as i,
  unnest(regexp_split_to_array(trim(condition), '\\s+')) as tok from {_STEPS})
where contains(condition, '{word}') and tok <> '' and tok not in ({_STOP})""" for name, word in _LISTS.items()))
def i20f(t: Tables):
    return token_rows(rule_text(t).select("p_partkey", "txt"), "txt")


@query("i21_contains_flag", "select doc_id, cast(contains(lower(text), 'li') as integer) as has_li from documents")
def i21(t: Tables):
    return t.documents.select("doc_id", S.contains_flag(F.col("text"), "li").alias("has_li"))


# a lexicon of our own; the fixtures' invented languages share these syllables
_LEX = ["error", "the of", "license", "email", "tion", "über"]


@query("i22_keyword_scores", "select doc_id, round((" + " + ".join(
    f"cast(contains(lower(text), '{k}') as integer)" for k in _LEX) + ") / 6.0, 8) as fraction, cast(" + " or ".join(
    f"contains(lower(text), '{k}')" for k in _LEX[:3]) + " as double) as any_hit from documents")
def i22(t: Tables):
    x = F.col("text")
    return t.documents.select("doc_id", rd(S.keyword_fraction(x, _LEX), 8).alias("fraction"), S.keyword_any(x, _LEX[:3]).alias("any_hit"))


@query("i23_prefix", "select doc_id, md5(substr(text, 1, 2000)) as digest from documents")
def i23(t: Tables):
    return t.documents.select("doc_id", F.md5(S.prefix(F.col("text")).cast("binary")).alias("digest"))


@query("i24_derived_columns", """
select p_partkey, round(p_size + p_retailprice, 6) as total, p_size * p_size as p_size_squared, round(p_size * p_retailprice, 4) as p_size_x_p_retailprice from part""")
def i24(t: Tables):
    d = shaping.derived_columns(t.part, {"total": ["p_size", "p_retailprice"]}, ["p_size"], [("p_size", "p_retailprice")])
    return d.select("p_partkey", rd("total").alias("total"), "p_size_squared", rd("p_size_x_p_retailprice", 4).alias("p_size_x_p_retailprice"))


@query("i25_parse_vector", """
select vec_id, round(list_sum(embedding::double[]), 5) as total, cast(len(embedding) as integer) as dims from embeddings""")
def i25(t: Tables):
    text = t.embeddings.select("vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("txt"))
    v = text.select("vec_id", X.parse_vector(F.col("txt")).alias("v"))
    return v.select("vec_id", rd(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 5).alias("total"), F.size("v").alias("dims"))


@query("i26_vector_stats", """
select vec_id, round(list_avg(embedding::double[]), 7) as vec_mean, round(list_stddev_pop(embedding::double[]), 7) as vec_std,
 round(list_max(embedding::double[]), 7) as vec_max, round(list_min(embedding::double[]), 7) as vec_min, cast(len(embedding) as integer) as vec_dim
from embeddings""")
def i26(t: Tables):
    stats = X.vector_stats(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", *[(c if n == "vec_dim" else rd(c, 7)).alias(n) for n, c in stats.items()])


@query("i27_canonical_key", "select n_nationkey, upper(trim('  ' || lower(n_name) || ' ')) as k, upper(trim(s_name)) as s from nation join supplier on s_nationkey = n_nationkey")
def i27(t: Tables):
    j = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select("n_nationkey", S.canonical_key(F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))).alias("k"),
                    S.canonical_key(F.col("s_name")).alias("s"))


@query("i28_camel_json", """
select p_partkey, '{"pSize":' || p_size || ',"retailPrice":' || cast(p_retailprice as varchar) || '}' as metrics from part""")
def i28(t: Tables):
    keys = {S.camel_key("p_size"): F.col("p_size"), S.camel_key("retail_price"): F.col("p_retailprice")}
    return t.part.select("p_partkey", F.to_json(F.struct(*[c.alias(k) for k, c in keys.items()])).alias("metrics"))


@query("i29_confidence", f"""
select claim_id, round(abs(probability_score - 0.5) * 2, 6) as confidence, cast(probability_score >= 0.3 as integer) as flagged from {SCORED}""")
def i29(t: Tables):
    p = F.col("probability_score")
    return scored(t).select("claim_id", rd(X.confidence(p)).alias("confidence"), X.label_at(p, 0.3).alias("flagged"))


@query("i30_max_probability", f"""
select claim_id, round(greatest(cast(probability_score as double), 1 - probability_score), 6) as best from {SCORED}""")
def i30(t: Tables):
    from pyspark.ml.functions import array_to_vector

    from tabloom.operators.models import max_probability

    p = F.col("probability_score")
    v = scored(t).select("claim_id", array_to_vector(F.array(p, 1 - p)).alias("probability"))
    return v.select("claim_id", rd(max_probability()).alias("best"))


@query("i31_event_message", """
select 'summary' as event_type, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' as event_message, 'new' as status from documents""")
def i31(t: Tables):
    from tabloom.plans.claims import event_row

    return event_row(t.documents, "summary", ["doc_id", "lang"], "new")


@query("i32_decode_labels", f"""
select claim_id, case (cast(claim_id as bigint) % 4) when 0 then 'gold' when 1 then 'silver' when 2 then 'bronze' end as plan_name from {SCORED}""")
def i32(t: Tables):
    d = scored(t).select("claim_id", (F.col("claim_id").cast("long") % 4).cast("double").alias("prediction"))
    return decode_labels(d, "prediction", ["gold", "silver", "bronze"], "plan_name").drop("prediction")


@query("i33_rule_scoring", """
select o_orderkey, case when o_orderstatus = 'F' and o_orderpriority = '3-MEDIUM' and o_totalprice >= 20000 then 0
  when o_orderstatus = 'F' then 1 else 0 end as survived from orders""")
def i33(t: Tables):
    f = F.col("o_orderstatus") == "F"
    rules = [(f, 1), (f & (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_totalprice") >= 20000), 0)]
    return t.orders.select("o_orderkey", X.decide(rules, 0).alias("survived"))
