"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table. ORACLE holds DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_format, collocations, exact_dedup, fertility, hnsw, html_wrapper, ngram_join, packing, quality_model, token_counts, url_rules, whitening
from .common import read

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_JSON, BYTE_JSON_EOD = public_tokenizers.path("byte_bpe_50k.json"), 50256
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_format.format_chats(read(spark, sf_dir, "conversations"))
    return out.select("conv_id", "part", "n_turns", "n_copies", "text", "n_chars",
                      F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]), F.lit(0)).alias("n_assistant_chars"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_text(read(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages"), url_rules.default_rules(spark))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the digests: n_chars (code points that the offsets cover) and n_split (tokens that end inside a character)."""
    encoded = byte_bpe.encode_texts(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    spans = encoded.select("doc_id", "ids", F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_chars"),
                           (F.size("ends") - F.size(F.array_distinct("ends"))).cast("long").alias("n_split"))
    decoded = byte_bpe.decode_texts(spans, BYTE_RANKS, public_tokenizers.PATTERN)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"), "n_chars", "n_split")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_model.fit_model(docs, read(spark, sf_dir, "labels"))
    return quality_model.score_texts(docs, model, ["doc_id"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), WORD_JSON)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_measures(read(spark, sf_dir, "documents"), PIECE_MODEL).drop("reasons")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(read(spark, sf_dir, "documents"), BYTE_JSON, BYTE_JSON_EOD).select("doc_id", "n_tokens")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_neighbours(read(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_format, op2_html_text, op3_exact_dedup, op4_ngram_join, op5_url_rules, op6_byte_bpe, op7_quality_model, op8_packing, op9_quality_rules,
                            op10_token_counts, op11_collocations, op12_hnsw_search, op13_whitening)}

ORACLE: dict[str, str] = {
    "op1_chat_format": r"""
with t as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
p as (select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as pos,
        count(*) over (partition by conv_id) as n_turns from t),
g as (select *, coalesce(length(role) || ':' || role, '-') || '|' || coalesce(length(text) || ':' || text, '-') || chr(10) as raw,
        regexp_replace(coalesce(role, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g') as r,
        regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g') as b from p),
f as (select *, md5(string_agg(raw, '') over (partition by conv_id order by pos)) as h from g),
w as (select h, n_turns, min(conv_id) as conv_id, count(*) as n_copies from f where pos = n_turns - 1 group by all),
k as (select * from w where h not in (select h from f where pos < n_turns - 1)),
s as (select f.conv_id, f.pos // 256 as part, f.pos, f.n_turns, k.n_copies, f.role, length(f.b) as nb,
        '<|im_start|>' || r || chr(10) || b || '<|im_end|>' || chr(10) as seg from f join k on f.conv_id = k.conv_id)
select conv_id, part, max(n_turns) as n_turns, max(n_copies) as n_copies, string_agg(seg, '' order by pos) as text,
  sum(length(seg)) as n_chars, coalesce(sum(nb) filter (where role = 'assistant'), 0) as n_assistant_chars
from s group by conv_id, part""",
    "op3_exact_dedup": r"""
with t as (select doc_id, coalesce(length(text), 0) as cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm from documents),
r as (select *, row_number() over (partition by norm order by cp desc, doc_id nulls last) as k, count(*) over (partition by norm) as n from t),
m as (select norm, doc_id as keep_id from r where k = 1)
select r.doc_id, m.keep_id, r.n as group_size, r.k = 1 as kept, sha256(r.norm) as text_sha256 from r join m on r.norm = m.norm""",
    "op5_url_rules": r"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages),
h as (select page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') as path from u),
r(rh, rp, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m as (select h.*, r.rh || r.rp as rule, r.v, row_number() over (partition by h.page_id order by length(r.rh || r.rp) desc nulls last, length(r.rh) desc) as k
      from h left join r on (h.host = r.rh or ends_with(h.host, '.' || r.rh)) and starts_with(h.path, r.rp))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1""",
    "op11_collocations": r"""
with p as (select doc_id, lang, row_number() over () as piece, p from (select doc_id, coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents)),
w as (select lang, piece, unnest(ws) as x, generate_subscripts(ws, 1) as i
      from (select lang, piece, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as ws from p)),
e as (select lang, x as w1, lead(x, 1) over v as w2, lead(x, 2) over v as w3, lead(x, 3) over v as w4 from w window v as (partition by piece order by i)),
g as (select lang, 1 as k, w1 as ph from e union all select lang, 2, w1 || ' ' || w2 from e where w2 is not null
      union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from e where w3 is not null
      union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 from e where w4 is not null),
f as (select lang, k, ph, count(*) as a from g group by all having count(*) >= 30),
n as (select lang, count(*) as n from w group by lang),
s as (select *, string_split(ph, ' ') as ws from f where k > 1),
c as (select s.lang, s.k, s.ph, s.a, cut, x.a as l, y.a as r, ((2000000::hugeint * s.a) // (x.a + y.a))::bigint as score
      from s cross join (select unnest([1, 2, 3]) as cut) join f x on x.lang = s.lang and x.ph = array_to_string(s.ws[1:cut], ' ')
      join f y on y.lang = s.lang and y.ph = array_to_string(s.ws[cut + 1:s.k], ' ') where cut < s.k),
b as (select * from c qualify row_number() over (partition by lang, ph order by score, cut) = 1),
h as (select lang, array_to_string(ws[o:o + m - 1], ' ') as ph, max(a) as a from s, unnest([2, 3]) as t(m), unnest([1, 2, 3]) as v(o)
      where m < k and o + m - 1 <= k group by all),
z as (select b.* from b left join h on h.lang = b.lang and h.ph = b.ph where h.a is null or 100 * h.a < 80 * b.a)
select z.lang, (row_number() over (partition by z.lang order by score desc, z.a desc, ph))::int as rank, ph as phrase, z.a, l, r, n.n, score
from z join n on n.lang = z.lang qualify rank <= 2000""",
}
