"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hackney.llm import (attention_lm, byte_bpe, chunk_bpe, common, decontam, licenses, lsh_forest, pii, quality_cascade,
                         ranked_search, token_files, toxicity, warc_bundles, word_runs)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return common.table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(token_files.write(_documents(spark, sf_dir)))


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return warc_bundles.read(warc_bundles.write(common.table(spark, sf_dir, "pages")))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.join(_documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return decontam.contamination(docs, common.table(spark, sf_dir, "benchmark")).drop("text_md5")


def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(_documents(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which rule rejects first depends on measured times; the verdict does not.
    return quality_cascade.report(_documents(spark, sf_dir)).drop("rejected_by", "rules_run")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.report(_documents(spark, sf_dir))


def op13_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.round_trip(_documents(spark, sf_dir))


# Words and windows by position; a window that occurs marks its words.
OP5_SQL = r"""
with w as (select doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' ') as a from documents),
dw as (select doc_id, case when a = [''] then [] else a end as a from w),
b as (select item_id, string_split(trim(regexp_replace(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' ') as a from benchmark),
bw as (select item_id, a from b where a <> [''] and item_id is not null),
q as (select distinct item_id, least(13, len(a)) as n, list_slice(a, k, k + least(13, len(a)) - 1) as win
      from (select item_id, a, unnest(range(1, greatest(1, len(a) - 12) + 1)) as k from bw)),
s as (select distinct n from q),
d as (select doc_id, n, k, list_slice(a, k, k + n - 1) as win
      from (select doc_id, a, n, unnest(range(1, len(a) - n + 2)) as k from dw, s where len(a) >= n)),
h as (select d.doc_id, d.k, d.n, q.item_id from d join q on d.n = q.n and d.win = q.win),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from h) group by 1),
it as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as items
       from (select distinct doc_id, cast(item_id as varchar) as i from h) group by 1)
select dw.doc_id, cast(len(a) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(a) as contaminated
from dw left join hit using (doc_id) left join it using (doc_id)
"""

# The smallest page of each payload is the response; base32 from the digest's hex.
OP3_SQL = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, octet_length(encode(h)) as n, sha1(h) as x, min(page_id) over (partition by h) as first from p)
select page_id, cast(n as bigint) as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + cast((cast('0x' || substr(x, 1 + 5 * cast(i // 4 as integer), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as integer), 1)),
         'string_agg', '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to from d
"""

# The measures word by word and line by line, and the six production rules.
OP10_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as a
           from documents),
m as (select doc_id, a, len(a) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as b,
             len(list_filter(range(1, len(a)), lambda i: a[i] = a[i + 1])) as n_stutters from d),
w as (select doc_id, i, list_slice(a, i, i + 4) as win from (select doc_id, a, unnest(range(1, len(a) - 3)) as i from m)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as k from w) where k > 1),
c as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from r) group by 1),
f as (select m.doc_id, n_words, word_chars, n_symbols, len(b) as n_lines, len(b) - len(list_distinct(b)) as n_dup_lines,
             n_stutters, coalesce(n, 0) as n_repeat_words from m left join c using (doc_id))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > n_words
            or not (2 * n_words <= word_chars and word_chars <= 20 * n_words)
            or 2 * n_stutters > n_words or 2 * n_dup_lines > n_lines) as kept from f
"""

# Every document scored against every item that shares a term with it.
OP11_SQL = r"""
with split as (select 0 as side, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
t as (select side, id, unnest(string_split(regexp_replace(translate(text,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ')) as w from split),
q as (select distinct id as item_id, w from t where side = 1 and w <> '' and id is not null),
tf as (select id as doc_id, w, count(*) as tf from t where side = 0 and w <> '' group by 1, 2),
d as (select doc_id, cast(sum(tf) as bigint) as n from tf group by 1),
c as (select count(*) as docs, cast(sum(n) as bigint) as total from d),
df as (select w, count(*) as df from tf group by 1),
wt as (select w, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * df + 1))) as bigint) as weight from df, c),
s as (select item_id, tf.doc_id, cast(sum(weight * ((1000000000 * tf) //
          (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total))))) as bigint) as score
      from q join tf using (w) join wt using (w) join d on d.doc_id = tf.doc_id, c group by 1, 2),
r as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
             doc_id, score from s where score > 0)
select * from r where rank <= 50
"""

# Equal words q apart, joined into islands; the checksum is CRC-32 bit by bit.
OP12_SQL = r"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as a,
             xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
                   lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
                 lambda c, e: xor(xor(c, e) >> 1, case when xor(c, e) & 1 = 1 then 3988292384::bigint else 0 end)),
               4294967295::bigint) as h from documents),
r as (select doc_id, a, len(a) as n, h, (h // 10) % greatest(len(a), 1) as s,
             1 + (len(a) - (h // 10) % greatest(len(a), 1)) // (3 + (h // 10) % 8) as p from d),
w as (select doc_id, n, i, a[1 + case when h % 10 = 0 and i >= s then s + (i - s) % p else i end] as w
      from (select *, unnest(range(0, n)) as i from r)),
m as (select x.doc_id, x.i, y.i - x.i as q from w x join w y on x.doc_id = y.doc_id and x.w = y.w
      and y.i > x.i and 4 * (y.i - x.i) <= x.n),
g as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as k from m),
u as (select doc_id, min(i) as start, max(i) + 1 + q - min(i) as length, q from g group by doc_id, q, k),
t as (select doc_id, start, length, min(q) as period from u where length >= greatest(6, 4 * q) group by 1, 2, 3),
o as (select doc_id, count(*) as n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as listed
      from t group by 1),
b as (select * from t qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1),
x as (select distinct doc_id, unnest(range(start + period, start + length)) as i from t),
k as (select doc_id, string_agg(w, ' ' order by i) as kept from w anti join x using (doc_id, i) group by 1)
select d.doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(start as bigint) as start, cast(length as bigint) as length,
       cast(period as bigint) as period, cast(1000 * length // period as bigint) as exponent_milli,
       sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from d left join o using (doc_id) left join b using (doc_id) left join k using (doc_id)
"""

# name: (query, DuckDB text or None where SQL cannot express it)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_token_files": (op2_token_files, None),
    "op3_warc_bundles": (op3_warc_bundles, OP3_SQL),
    "op4_ngram_jaccard": (op4_ngram_jaccard, None),
    "op5_decontamination": (op5_decontamination, OP5_SQL),
    "op6_attention_lm": (op6_attention_lm, None),
    "op7_byte_bpe": (op7_byte_bpe, None),
    "op8_licenses": (op8_licenses, None),
    "op9_pii": (op9_pii, None),
    "op10_quality_cascade": (op10_quality_cascade, OP10_SQL),
    "op11_ranked_search": (op11_ranked_search, OP11_SQL),
    "op12_word_runs": (op12_word_runs, OP12_SQL),
    "op13_chunk_bpe": (op13_chunk_bpe, None),
}
