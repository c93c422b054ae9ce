"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tabloom.llm import (chat, chat_repair, exact_dedup, importance, license_scan, line_dedup, ngram_join, packing, quality, secret_scan,
                         sentencepiece_codec, toxicity, url_filter)
from tabloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


SQL["op1_suffix_line_dedup"] = r"""
with l as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i
  from documents where text is not null),
w as (select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from l),
p as (select a.doc_id, a.i, a.words, b.doc_id as d2, a.i - b.i as shift from w a join w b
  on a.line = b.line and (b.doc_id < a.doc_id or (b.doc_id = a.doc_id and b.i < a.i))),
r as (select *, i - row_number() over (partition by doc_id, d2, shift order by i) as run from p),
g as (select distinct doc_id, i from (select *, sum(words) over (partition by doc_id, d2, shift, run) as total from r) where total >= 10)
select d.doc_id, case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
  coalesce(k.removed, 0) as lines_removed, case when d.text is null then null else coalesce(k.left_text, '') end as text
from documents d left join (select w.doc_id, count(g.i) as removed,
  string_agg(w.line, chr(10) order by w.i) filter (g.i is null) as left_text
  from w left join g on w.doc_id = g.doc_id and w.i = g.i group by w.doc_id) k on d.doc_id = k.doc_id
"""


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


SQL["op3_quality_divergence"] = r"""
with recursive d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from d),
lines as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
m as (select doc_id, lang, words, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
  length(t) as all_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
  length(regexp_replace(t, '\PL', '', 'g')) as letters, length(regexp_replace(t, '\P{Lu}', '', 'g')) as up,
  length(regexp_replace(t, '[^0-9]', '', 'g')) as digit from w),
c as (select *, [up, letters - up, digit, all_chars - word_chars, n_symbols, word_chars - letters - digit - n_symbols] as cls from m),
dup as (select doc_id, len(ls) - len(list_distinct(ls)) as n_dup_lines from lines),
win as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as s
  from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as k from win) where k > 1),
rep as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from twice) group by doc_id),
names as (select lang from m where lang <> '*' group by lang having count(*) >= 50 and sum(n_words) >= 5000),
keyed as (select c.*, coalesce(n.lang, '*') as key from c left join names n on c.lang = n.lang),
pool as (select lang as key, n_words, cls, words from c where lang in (select lang from names)
  union all select '*', n_words, cls, words from c),
tot as (select key, sum(n_words) as r_words, [sum(cls[1]), sum(cls[2]), sum(cls[3]), sum(cls[4]), sum(cls[5]), sum(cls[6])] as r_cls
  from pool group by key),
cnt as (select key, word, count(*) as n from (select key, unnest(words) as word from pool) group by all),
top as (select key, word, n, row_number() over (partition by key order by n desc, word) as r from cnt qualify r <= 16),
cd as (select k.doc_id, sqrt(greatest(0, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
    + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2)) as char_distance
  from (select k.doc_id, unnest(range(1, 7)) as i, cls, all_chars, r_cls from keyed k join tot on k.key = tot.key) k,
  lateral (select case when all_chars > 0 then cls[i] / all_chars::double else 0 end as p,
    case when list_sum(r_cls) > 0 then r_cls[i] / list_sum(r_cls)::double else 0 end as q) group by k.doc_id),
here as (select k.doc_id, k.key, k.n_words, top.n, len(list_filter(k.words, lambda x: x = top.word)) as h
  from keyed k join top on k.key = top.key),
pq as (select doc_id, case when h.n_words > 0 then h / h.n_words::double else 0 end as p, n / tot.r_words::double as q
  from here h join tot on h.key = tot.key
  union all select doc_id, greatest(0, 1 - sum(case when h.n_words > 0 then h / h.n_words::double else 0 end)),
    greatest(0, 1 - sum(n / tot.r_words::double)) from here h join tot on h.key = tot.key group by doc_id),
wd as (select doc_id, sqrt(greatest(0, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
    + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2)) as word_distance from pq group by doc_id),
cov as (select top.key, sum(n) as common, max(tot.r_words) as r_words, sum(n / tot.r_words::double) as c from top join tot on top.key = tot.key group by top.key),
lim as (select key, common, r_words, round(sqrt(greatest(0, c + log2(2 / (1 + greatest(0, 1 - c))) + case when c < 1 then (1 - c) * log2(2 * (1 - c) / (2 - c))
  else 0 end) / 2), 6) as no_words from cov),
j as (select m.doc_id, m.n_words, m.word_chars, m.n_symbols, dup.n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
  m.n_words < 20 or 100 * coalesce(rep.n, 0) > 30 * m.n_words as base_failed,
  round(cd.char_distance, 6) as char_distance, round(coalesce(wd.word_distance, 0), 6) as word_distance,
  coalesce(m.n_words * lim.common >= 8 * lim.r_words, false) as enough, lim.no_words
  from m join dup on m.doc_id = dup.doc_id left join rep on m.doc_id = rep.doc_id
  left join cd on m.doc_id = cd.doc_id left join wd on m.doc_id = wd.doc_id
  join keyed on m.doc_id = keyed.doc_id left join lim on keyed.key = lim.key)
select * exclude (enough, no_words), not base_failed and not (n_words >= 50 and (char_distance > 0.32
  or (enough and word_distance > 0.95 * no_words))) as kept from j
"""


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


@query
def op5_redirect_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op6_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"))


@query
def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.render(chat.event_log(turns), together=True), together=True)


SQL["op8_event_sourced_chat"] = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, 13 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\]', '', 'g'))
  + len(regexp_extract_all(text, '</?s>|\[/?INST\]')) + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) as chars from t),
g as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role) as turns,
  coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '') as loss, sum(chars) as formatted_chars
  from e group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars from g
"""


@query
def op9_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_grace_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


SQL["op10_grace_hash_dedup"] = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
n as (select doc_id, length(t) as c, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') as b from d),
g as (select b, count(*) as k, arg_min(doc_id, (-c, doc_id)) as keep_id from n group by b)
select doc_id, keep_id, k as group_size, doc_id = keep_id as kept, sha256(n.b) as text_sha256
from n join g on n.b = g.b
"""


@query
def op11_segment_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op11_segment_importance"] = r"""
with t8 as (select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1
    then xor(3988292384, c >> 1) else c >> 1 end, i)) as crc),
src as (select row_number() over () as k, 0 as side, text from documents union all select 0, 1, text from benchmark),
w as (select k, side, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from src),
b as (select word, xor(4294967295, list_reduce(list_transform(range(length(hex(encode(word))) // 2),
    lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295)) % 10000 as bucket
  from (select distinct word from w), t8),
f as (select k, side, bucket from w join b on w.word = b.word),
n as (select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from f group by bucket),
tot as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from n),
g as (select bucket, floor(1000 * ln((n.t + 1)::double * (tot.s + 10000)::double / ((n.s + 1)::double * (tot.t + 10000)::double)))::bigint as gain
  from n, tot),
d as (select k, count(*) as n_features, sum(gain)::bigint as weight from f join g on f.bucket = g.bucket where side = 0 group by k),
s as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5)::double / 4294967296)))::bigint as score
  from (select row_number() over () as k, doc_id from documents) x left join d on x.k = d.k),
r as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place from s)
select doc_id, n_features, weight, score, case when n_features >= 20
  and place <= (select count(*) from s where n_features >= 20) * 10 // 100 then place end as rank from r
"""


@query
def op12_hirschberg_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return chat_repair.report(chat_repair.damage(conversations), conversations)


SQL["op12_hirschberg_chat_repair"] = r"""
with recursive t8 as (select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1
    then xor(3988292384, c >> 1) else c >> 1 end, i)) as crc),
c as (select conv_id, dense_rank() over (order by conv_id) as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
h as (select name, xor(4294967295, list_reduce(list_transform(range(length(name)), lambda i: ascii(substr(name, i + 1, 1))::bigint),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295)) % 20 as kind from (select distinct name from c), t8),
d as (select conv, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as again from c join h on c.name = h.name),
o as (select *, row_number() over (partition by conv order by turn nulls first, role, md5(text)) as i from d),
r as (select *, case left(role, 1) when 's' then 1 when 'u' then 2 when 'a' then 3 else 9 end as own,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b'
      when row_number() over (partition by conv, role, text order by i) > 1 then 'd'
      when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 't' else '' end as fault,
    coalesce(lag(left(role, 1)) over (partition by conv order by i) || left(role, 1) not in ('su', 'ua', 'au'), false) as wrong from o),
ins as (select s as before, s as state, 0 as k, '' as said from range(4) as x(s)
  union all select before, case state when 2 then 3 else 2 end, k + 1,
    said || case state when 2 then 'assistant:' else 'user:' end || chr(10) from ins where k < 3),
opt as (select ins.*, letter from ins, (values ('D'), ('K'), ('R')) as l(letter)),
p as (select conv, 0 as i, 0 as s, 0 as cost, '' as audit, '' as said from (select distinct conv from r)
  union all
  select conv, i, after, min(cost), arg_min(audit, (cost, audit)), arg_min(said, (cost, audit)) from (
    select p.conv, r.i, case letter when 'D' then state when 'K' then own else case state when 2 then 3 else 2 end end as after,
      p.cost + 3 * k + case letter when 'D' then 4 when 'R' then 3 else 0 end + case when letter <> 'D' and fault = 't' then 3 else 0 end as cost,
      p.audit || repeat('I', k) || letter as audit,
      p.said || opt.said || case letter when 'D' then '' when 'K' then role || ':' || text || chr(10)
        else case state when 2 then 'assistant:' else 'user:' end || text || chr(10) end as said
    from p join r on p.conv = r.conv and r.i = p.i + 1 join opt on opt.before = p.s
    where letter = 'D' or (fault not in ('b', 'd') and (letter = 'R' or own = case state when 2 then 3 else 2 end or (own = 1 and state = 0))))
  group by conv, i, after),
f as (select p.conv, arg_min(struct_pack(cost := cost + [0, 6, 3, 0][s + 1], audit := audit || ['', 'II', 'I', ''][s + 1],
    said := said || ['', 'user:' || chr(10) || 'assistant:' || chr(10), 'assistant:' || chr(10), ''][s + 1]),
    (cost + [0, 6, 3, 0][s + 1], audit || ['', 'II', 'I', ''][s + 1])) as best
  from p join (select conv, max(i) as n from r group by conv) m on p.conv = m.conv and p.i = m.n group by p.conv),
g as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
  count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (wrong) as illegal from r group by conv)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
  coalesce(best.audit, '') as audit, sha256(coalesce(left(best.said, length(best.said) - 1), '')) as repaired_sha256
from (select distinct conv_id, conv from c) a left join g on a.conv = g.conv left join f on a.conv = f.conv
"""


@query
def op13_checksum_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
