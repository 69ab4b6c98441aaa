"""The registered queries of this package, as the contracts ask for them, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.bpe_words import encode
from larder.llm.common import fresh, table
from larder.llm.embedding_dedup import near_vectors
from larder.llm.exact_dedup import exact_duplicates
from larder.llm.licenses import license_report, scan_licenses
from larder.llm.mil_quality import quality_scores
from larder.llm.mixing import with_copies
from larder.llm.ngram_join import ngram_classes
from larder.llm.packing import pack
from larder.llm.phrases import collocations
from larder.llm.suffix_dedup import without_repeats
from larder.llm.suffix_lm import suffix_scores
from larder.llm.token_counts import recount, redactions
from larder.llm.whitening import whiten

Run = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer of the contracts: a file of the image, on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(scan_licenses(table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = fresh(docs, "mix")
    taken = (F.col(f"{mix}.copies") * F.col(f"{mix}.size")).alias("taken")
    return with_copies(docs, out=mix).select("doc_id", f"{mix}.size", f"{mix}.source_size", f"{mix}.target", taken)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens before and after its personal data is redacted; leaves are kept for later edits."""
    return recount(redactions(table(spark, sf_dir, "documents")), tokenizer_file())


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op9_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_scores(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chars")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP3_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5('mix|' || coalesce(doc_id::varchar, '')) as h
  from documents),
k as (select *, coalesce('=' || source, 'null') as key, lpad(length(bin(size))::varchar, 2, '0') || '.' || substr(bin(size), 2, 3) as kind from d),
s as (select source, key, sum(size) as source_size from k group by 1, 2),
w as (select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight, 2 * source_size as cap from s),
f as (
  select *, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as filled,
    sum(weight) over (o rows between current row and unbounded following) as rest,
    sum(source_size) over () as total, row_number() over o as place
  from w window o as (order by cap::double / weight, source nulls last)),
l as (select *, (3 * total - 2 * filled)::double / (2 * rest)::double as level from f),
x as (select *, min(case when weight * level <= cap then place end) over () as first_place from l),
t as (select source, key, source_size, weight, cap, max(case when place = first_place then level end) over () as top from x),
g as (select key, source_size, least(cap::double, weight * coalesce(top, 'infinity'::double)) as target from t),
r as (
  select k.doc_id, k.size, g.source_size::bigint as source_size, g.target,
    case when g.source_size > 0 then g.target / g.source_size::double else 0 end as rate,
    (row_number() over (partition by k.key order by k.kind, k.h, k.doc_id))::double as n,
    ('0x' || substr(md5('mix|' || k.key), 1, 8))::bigint / 4294967296.0::double as start
  from k join g using (key))
select doc_id, size, source_size, target, ((floor(rate * n + start) - floor(rate * (n - 1) + start)) * size)::bigint as taken from r
"""

OP10_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
g as (
  select *, first_value(doc_id) over w as keep_id, row_number() over w as place, count(*) over (partition by text_sha256) as group_size
  from d window w as (partition by text_sha256 order by n desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from g
"""

OP12_SQL = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, 'und') as lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
  from documents),
p as (select lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') as w from d),
g as (
  select lang, unnest(list_concat(
    list_transform(range(1, len(w) + 1), lambda i: {'phrase': w[i], 'words': 1}),
    list_transform(range(1, len(w)), lambda i: {'phrase': concat_ws(' ', w[i], w[i + 1]), 'words': 2}),
    list_transform(range(1, len(w) - 1), lambda i: {'phrase': concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'words': 3})), recursive := true)
  from p),
f as (select lang, phrase, words, count(*) as f from g group by all),
t as (select lang, sum(f)::bigint as n from f where words = 1 group by lang),
c as (select lang, phrase, words, f as a, string_split(phrase, ' ') as w from f where words > 1 and f >= 10),
i as (
  select lang, phrase, max(a) as longer from (
    select lang, a, unnest([concat_ws(' ', w[1], w[2]), concat_ws(' ', w[2], w[3])]) as phrase from c where words = 3)
  group by all),
k as (select c.*, unnest(range(1, words)) as k from c left join i using (lang, phrase) where longer is null or 100 * longer < 50 * a),
s as (
  select k.lang, k.phrase, a, k, l.f as l, r.f as r, (1000000::hugeint * a * a // (l.f::hugeint * r.f))::bigint as score
  from k join f l on l.lang = k.lang and l.phrase = array_to_string(k.w[1:k.k], ' ') and l.words = k.k
    join f r on r.lang = k.lang and r.phrase = array_to_string(k.w[k.k + 1:], ' ') and r.words = k.words - k.k),
m as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from m)
select lang, rank, phrase, a, l, r, n, score from o join t using (lang) where rank <= 2000
"""

QUERIES: dict[str, Run] = {
    "op1_mil_quality": op1_mil_quality,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_join": op6_ngram_join,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_suffix_lm": op9_suffix_lm,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_phrases": op12_phrases,
    "op13_word_bpe": op13_word_bpe,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {
    "op3_mixing": OP3_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_phrases": OP12_SQL,
}
