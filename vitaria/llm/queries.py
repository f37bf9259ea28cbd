"""Queries of the operators over their whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vitaria.llm.chat import CONTROLS, format_chats, read_turns, unescape
from vitaria.llm.classifier import score_quality
from vitaria.llm.collocations import mine_collocations
from vitaria.llm.fingerprints import fingerprint_neighbours
from vitaria.llm.html_text import extract_main_text
from vitaria.llm.lm import score_texts
from vitaria.llm.mixing import mix_sources
from vitaria.llm.packing import pack_documents, word_tokens
from vitaria.llm.prefix_trie import prefix_trie
from vitaria.llm.quality import quality_rules
from vitaria.llm.simhash import simhash_groups
from vitaria.llm.substrings import mark_repeats
from vitaria.llm.toxicity import score_toxicity
from vitaria.llm.words import SPACE_PATTERN

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LINE = r"regexp_replace(trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g')"


def quality_sql(docs: str) -> str:
    """All columns of the rules for the rows of a table or view."""
    return rf"""
with d as materialized (select row_number() over () as r, *, {_WORDS} as w from {docs}),
l as (select r, source, substr(md5({_LINE}), 1, 16) as h, x, i from (
    select r, source, unnest(string_split(coalesce(text, ''), chr(10))) as x,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from d)),
lw as (select * from l where regexp_matches(x, '[^\x20\x09-\x0D]')),
s as (select r, string_agg(distinct h, ' ' order by h) as document from lw group by r),
c as (select source, h, count(distinct document) as n from lw join s using (r) group by source, h),
hosts as (select source, count(distinct document) as docs from lw join s using (r) group by source),
f as (select c.source, c.h from c join hosts on c.source is not distinct from hosts.source where n > 10 and n > docs * 0.02::double),
p as (select r, unnest(range(1, len(w) - 1)) as i, w from d where len(w) > 3),
t as (select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n from p),
rep as (select r, count(distinct i + k) as n_repeat_words from t, (select unnest([0, 1, 2]) as k) where n > 1 group by r),
dup as (select r, count(*) - count(distinct x) as n_dup_lines from lw group by r),
kept as (select l.r, string_agg(l.x, chr(10) order by i) as kept_text from l
    left join f on l.source is not distinct from f.source and l.h = f.h and regexp_matches(l.x, '[^\x20\x09-\x0D]')
    where f.h is null group by l.r),
m as (select d.*, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(kept_text, '') as kept_text,
    len(regexp_extract_all(coalesce(kept_text, ''), '[^\x20\x09-\x0D]+')) as n_kept_words
    from d left join rep using (r) left join dup using (r) left join kept using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_kept_words >= n_words * 0.5::double as kept from m"""


@query(
    "op1_quality_rules",
    "select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_kept_words"
    f" from ({quality_sql('documents')})",
)
def quality(spark, sf_dir):
    rules = quality_rules(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words"]
    return rules.select("doc_id", *[F.col(f"qr_{n}").alias(n) for n in names])


def mixing_sql(docs: str) -> str:
    """Size, source size, target and repetitions for the rows of a table or view."""
    return rf"""
with d as materialized (select *, len({_WORDS})::bigint as size,
  md5('mix|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) as key from {docs}),
s as (select source, sum(size)::bigint as source_size, 2.0::double * sum(size) as cap,
  [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from d group by source),
o as (select *, row_number() over (order by cap / weight, source nulls last) as k from s),
v as (select k, cap, weight, (1.5 * (select sum(size) from d)
    - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by k rows between current row and unbounded following) as level from o),
e as (select level from v where level * weight <= cap order by k limit 1),
t as (select source, source_size, least(cap, weight * coalesce((select level from e), 1e300))::double as target from s),
g as (select d.*, source_size, target, floor(case when source_size > 0 then target / source_size else 0 end) as epochs,
  coalesce(sum(size) over (partition by d.source order by key rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source)
select *, (epochs + case when target - epochs * source_size > 0 and size > 0
    and 2 * before + size <= 2 * (target - epochs * source_size) then 1 else 0 end)::int as repeats from g"""


@query(
    "op2_mix_sources",
    f"select doc_id, size, source_size, target, size * repeats as taken from ({mixing_sql('documents')})",
)
def mixing(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    taken = (F.col("mix_size") * F.col("mix_repeats")).alias("taken")
    names = {"size": "mix_size", "source_size": "mix_source_size", "target": "mix_target"}
    return mixed.select("doc_id", *[F.col(c).alias(n) for n, c in names.items()], taken)


@query("op3_substring_dedup")
def substrings(spark, sf_dir):
    marked = mark_repeats(table(spark, sf_dir, "documents"))
    kept = F.trim(F.regexp_replace("rep_kept", SPACE_PATTERN, " "))
    return marked.select(
        "doc_id", F.col("rep_words").alias("n_words"), F.col("rep_removed").alias("n_removed"), F.sha2(kept, 256).alias("kept_sha256")
    )


_CONTROL = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS)
_CONTROLS_IN = lambda column: f"len(regexp_extract_all({column}, '{_CONTROL}'))"
CHATS_SQL = rf"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
  coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
  sum({sum(map(len, CONTROLS[:3])) + 1} + length(role) + length(text) + {_CONTROLS_IN('role')} + {_CONTROLS_IN('text')})::bigint as formatted_chars
  from t group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars from s"""


@query("op4_format_chats", CHATS_SQL)
def chats(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)

    @pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    def read_back(formatted: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(formatted, spans, strict=True):
            turns = read_turns(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in found)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
            rows.append((len(turns), digests[0], len(loss), digests[1]))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])

    formatted = format_chats(rows.union(added)).withColumn("read", read_back("formatted", "loss_spans"))
    return formatted.select("conv_id", "read.*", F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op5_pack_documents")
def packing(spark, sf_dir):
    tokens = word_tokens(public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), tokens)


@query("op6_order_minhash")
def fingerprints(spark, sf_dir):
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op7_score_texts")
def language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("learns", _remainder(7) != 2)
    return score_texts(docs, "learns").withColumn("held_out", F.coalesce(_remainder(7) == 2, F.lit(False)))


@query("op8_simhash_groups")
def simhash(spark, sf_dir):
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", digits, "component_id")


@query("op9_score_quality")
def classifier(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").where(_remainder(4) != 2)
    scores = score_quality(table(spark, sf_dir, "documents"), labels)
    return scores.select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op10_main_text")
def main_texts(spark, sf_dir):
    pages = extract_main_text(table(spark, sf_dir, "pages")).withColumnRenamed("main_text", "text")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


_BYTES_AND_BITS = "flatten(list_transform(string_split({0}::varchar, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
#: CRC-32 of a number's digits: a byte is xored in, eight times -1 shifts a bit out.
_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::bigint, " + _BYTES_AND_BITS + "), lambda a, x:"
    " case when x >= 0 then xor(a, x::bigint) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"
)
TRIE_SQL = rf"""
with t as (select conv_id as c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as m,
    strlen(coalesce(text, '')) as bytes, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null),
v as (select c, list(m order by i) as m, list(bytes order by i) as b, {_CRC_SQL.format("c")} % 9 as h from t group by c),
r as (select v.c, list_concat(coalesce(o.m, []::varchar[])[1:v.h], v.m[v.h + 1:]) as m, list_concat(coalesce(o.b, []::bigint[])[1:v.h], v.b[v.h + 1:]) as b
  from v left join v o on o.c = v.c - v.c % 5),
p as (select c, d, len(m) as total, case when d > 0 then b[d] else 0 end as bytes, md5(array_to_string(m[1:d], ' ')) as key
  from (select *, unnest(range(0, len(m) + 1)) as d from r)),
n as (select d, key, min(c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes, bool_and(d = total) as leaf,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (d = total), '')) as ends_sha256 from p group by d, key),
u as (select n.d, n.key, n.leaf, (n.n_convs - 1) * n.bytes as saved, q.d as above, q.key as above_key
  from n join p q on q.c = n.conv_id and q.d <= n.d),
s as (select above, above_key, count(*) filter (leaf) as n_leaves, sum(saved)::bigint as saved_tokens,
  count(*) filter (u.d = above + 1) as n_children from u group by above, above_key)
select n.conv_id, n.d as depth, a.conv_id as parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
from n join s on s.above = n.d and s.above_key = n.key
left join p q on q.c = n.conv_id and q.d = n.d - 1 left join n a on a.d = q.d and a.key = q.key"""


@query("op11_prefix_trie", TRIE_SQL)
def trie(spark, sf_dir):
    return prefix_trie(
        table(spark, sf_dir, "conversations"), lambda c: c - c % 5, lambda c: F.crc32(c.cast("string").cast("binary")) % 9
    )


@query("op12_toxicity")
def toxicity(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").where(_remainder(3) != 1)
    scores = score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scores.select(
        "doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op13_collocations")
def collocations(spark, sf_dir):
    return mine_collocations(table(spark, sf_dir, "documents"))
