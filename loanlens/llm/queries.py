"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.llm.common import read

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: The fixed rules of op2: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_OP2 = """
with p as (select page_id,
  case when url like '%://%' then translate(regexp_extract(substr(url, instr(url, '://') + 3), '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
  case when url like '%://%' then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
r(rh, rp, rv) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
d as (select distinct host, path from p),
f as (select host, path, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(rv, length(rh || rp)) as rv from d, r
  where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by host, path)
select page_id, p.host, p.path, f.rule, coalesce(f.rv, 'allow') as verdict from p left join f on p.host = f.host and p.path = f.path
"""


@register("op2_url_filters", _OP2)
def op2(spark, sf_dir):
    """Verdict of every page's url under the four fixed rules."""
    from loanlens.llm.url_filters import filter_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


_OP3 = """
with d as (select doc_id, source, coalesce(text, '') as t,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
k as (select doc_id, source, size,
    -ln((('0x' || substr(md5(concat('0|', coalesce(doc_id::varchar, '~'), '|', md5(t))), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
    / (case when length(t) > 0 then 0.5::double + length(regexp_replace(t, '[^\\pL]+', '', 'g'))::double / length(t)::double else 0.5::double end) as key
  from d),
s as (select source, sum(size)::bigint as source_size from k group by source),
w as (select source, source_size, ((row_number() over (order by source nulls last)) - 1) % 3 + 1 as weight from s),
o as (select *, source_size * 3 as cap, row_number() over (order by source_size * 3.0::double / weight, weight, source nulls last) as i from w),
c as (select *, ((select sum(source_size) from s) - coalesce(sum(cap) over (order by i rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by i rows between current row and unbounded following))::double as share from o),
l as (select coalesce(min(share) filter (where share * weight <= cap), 0) as share from c),
first_l as (select share from c where share * weight <= cap order by i limit 1),
p as (select source, source_size, least(cap::double, (select share from first_l) * weight) as target from o),
e as (select *, case when source_size > 0 then least(3, floor(target / source_size))::bigint else 0 end as epochs from p),
g as (select source, key, sum(size) as words from k group by source, key),
cum as (select source, key, words, coalesce(sum(words) over (partition by source order by key rows between unbounded preceding and 1 preceding), 0)::bigint as before from g),
b as (select cum.source, min(key) as cut, arg_min((target - epochs * source_size - before) / words::double, key) as share
  from cum join e on cum.source is not distinct from e.source where before + words > target - epochs * source_size group by cum.source)
select k.doc_id, k.size, e.source_size, e.target,
  (k.size * e.epochs + case when k.key < b.cut then k.size when k.key = b.cut then floor(k.size * b.share) else 0 end)::bigint as taken
from k join e on k.source is not distinct from e.source left join b on k.source is not distinct from b.source
"""


@register("op3_mixing", _OP3)
def op3(spark, sf_dir):
    """Words that the mix of all sources takes from every document."""
    from loanlens.llm.mixing import mix
    return mix(read(spark, sf_dir, "documents"))


@register("op7_benchmark_decontamination")
def op7(spark, sf_dir):
    """Benchmark items that each document holds, question and answer verified."""
    from loanlens.llm.decontaminate import contaminated
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    from loanlens.llm.simhash import simhash_components
    return simhash_components(read(spark, sf_dir, "documents"), shingle=3, max_distance=2)


_OP9 = """
with d as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
x as (select distinct doc_id, source, regexp_replace(l, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') as l
  from (select doc_id, source, unnest(ls) as l from d) where regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
t as (select source, count(*) as pages from d group by source),
b as (select x.source, l from x join t on x.source is not distinct from t.source
  group by x.source, l, pages having count(*) >= 5 and count(*) > pages * 0.1::double),
k as (select source, list(l) as bl from b group by source),
m as (select d.*, list_filter(ls, lambda z: not (bl is not null and list_contains(bl, regexp_replace(z, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')))) as fin
  from d left join k on d.source is not distinct from k.source)
select doc_id, case when text is null then null else array_to_string(fin, chr(10)) end as text,
  coalesce(len(ls), 0)::bigint as n_lines, coalesce(len(ls) - len(fin), 0)::bigint as n_dropped from m
"""


@register("op9_line_dedup", _OP9)
def op9(spark, sf_dir):
    """Every document without its source's boilerplate lines."""
    from loanlens.llm.line_dedup import drop_boilerplate
    return drop_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "text", "n_lines", "n_dropped")


@register("op10_quality_rules")
def op10(spark, sf_dir):
    """Quality measures and verdict of every document."""
    from loanlens.llm.quality_rules import judge_quality
    return judge_quality(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@register("op1_language_id")
def op1(spark, sf_dir):
    """Predicted language of every document; learned from those of remainder 0, 1 and 3."""
    from loanlens.llm.common import crc_mod
    from loanlens.llm.language_id import identify, train
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)))
    model = train(docs.filter("not held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "bits", F.col("rejected").cast("boolean").alias("rejected"))


@register("op4_lm_scoring")
def op4(spark, sf_dir):
    """Hidden Markov and unigram log10 probability of every document."""
    from loanlens.llm.common import crc_mod
    from loanlens.llm.hmm_lm import score_lm
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 5) == 1, F.lit(False)))
    return score_lm(docs)


@register("op5_toxicity")
def op5(spark, sf_dir):
    """Toxicity score of every document; learned from labels of remainder 1 to 4."""
    from loanlens.llm.common import crc_mod
    from loanlens.llm.toxicity import labelled, score_toxicity, train
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)))
    model = train(labelled(docs, read(spark, sf_dir, "labels"), "toxic", ~F.col("held_out")))
    return score_toxicity(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def raw_transcripts(conversations):
    """Stand-in input: turns of ``conversations`` as raw transcript text.

    Each conversation is written in one of four marker styles, one turn in five
    without a marker, as in logs pasted from various tools.
    """
    style = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    bare = F.pmod(F.crc32(F.concat_ws("-", "conv_id", "turn").cast("binary")), F.lit(5)) == 0
    user, ai = F.col("role") == "user", F.col("role") == "assistant"
    mark = (F.when(bare | F.col("role").isNull(), F.lit(""))
            .when(style == 0, F.concat(F.initcap("role"), F.lit(": ")))
            .when(style == 1, F.when(user, "Q: ").when(ai, "A: ").otherwise("### System: "))
            .when(style == 2, F.when(user, "[Human] ").when(ai, "[AI] ").otherwise("[System] "))
            .otherwise(F.concat(F.lit("<|"), "role", F.lit("|> "))))
    return conversations.withColumn("text", F.concat(mark, F.coalesce("text", F.lit(""))))


@register("op6_chat_formatting")
def op6(spark, sf_dir):
    """Every conversation's lines with the roles recovered from raw transcripts; tables from three quarters of them."""
    from loanlens.llm.chat_format import format_chats, train
    from loanlens.llm.common import crc_mod
    raw = raw_transcripts(read(spark, sf_dir, "conversations"))
    model = train(raw.filter(F.coalesce(crc_mod(F.col("conv_id"), 4) != 2, F.lit(False))))
    return format_chats(raw.drop("role"), model)


@register("op13_minhash_near_dedup")
def op13(spark, sf_dir):
    """Near-duplicate component of every document by three-word shingles at similarity 0.85."""
    from loanlens.llm.setsketch import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)


_OP11 = """
with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as a, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.r <> b.r where a.vec_id % 50 = 0),
p as (select a, anchor_id, id as positive_id, score as positive_score, row_number() over (partition by a order by score desc, id nulls last) as slot
  from s where same qualify slot <= 5)
select p.anchor_id, positive_id, (row_number() over (partition by p.a, slot order by score desc, id nulls last))::int as rank,
  id as negative_id, positive_score, score as negative_score
from p join s on p.a = s.a and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""


@register("op11_hard_negatives", _OP11)
def op11(spark, sf_dir):
    """Three hard negatives for each of five positives of every anchor."""
    from loanlens.llm.hard_negatives import hard_negatives
    vectors = read(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


_OP12 = r"""
with t as (select row_number() over () as r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws
  from documents where text is not null),
d as (select r, doc_id, ws, len(ws)::bigint as n from t where len(ws) > 0),
g as (select count(*)::bigint as docs, sum(n)::bigint as words from d),
i as (select row_number() over () as i, item_id, unnest(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) as w from benchmark),
f as (select r, w, count(*)::bigint as tf from (select r, unnest(ws) as w from d) where w in (select w from i) group by r, w),
k as (select w, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from f, g group by w),
p as (select f.r, d.doc_id, f.w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) as part
  from f join d using (r) join k using (w), g),
s as (select i, item_id, r, doc_id, sum(part)::bigint as score from i join p using (w) group by all)
select item_id, (row_number() over (partition by i order by score desc, doc_id nulls last))::int as rank, doc_id, score
from s where score > 0 qualify rank <= 10
"""


@register("op12_ranked_search", _OP12)
def op12(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    from loanlens.llm.maxsketch import rank_documents
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark").select("item_id", "text"))
