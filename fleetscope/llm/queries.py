"""The registered queries of the training-data operators: thin digests of what the operators
return, over whole tables, and the DuckDB text of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import (
    bpe, chat, decontaminate, html_text, langid, merkle, multi_index, packing, pii, quality, simhash, token_files, variants,
)
from fleetscope.llm.common import ascii_lower, scratch, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, WORD_BPE, end_id=1)
    return token_files.read_token_files(spark, folder)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE)
    return bpe.decode(ids, WORD_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    formatted = chat.render(chat.reconstruct(chat.turn_events(turns.unionByName(more))))
    read = formatted.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                            chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), WORD_BPE, end_id=0, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.session_key(spark))


def training_rows(docs: DataFrame) -> DataFrame:
    """The documents that may teach: labelled, and crc32 of the id as text mod 3 is not 1."""
    return docs.where((F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("lang").isNotNull())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(training_rows(docs)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, html_text.fit(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.audit(table(spark, sf_dir, "documents"), received={"text": text})


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_token_files, op3_bpe, op4_chat, op5_simhash, op6_neighbours,
                                   op7_packing, op8_surrogates, op9_language_id, op10_html_text, op11_variants,
                                   op12_merkle, op13_decontamination)}

_OP1_SQL = r"""
with d as (select row_number() over () as rn, doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
windows as (select rn, unnest(range(1, len(words) - 6)) as i, words from w where len(words) > 8),
keyed as (select rn, i, list_slice(words, i, i + 7) as k from windows),
twice as (select rn, i from (select rn, i, count(*) over (partition by rn, k) as c from keyed) where c > 1),
covered as (select rn, count(distinct i + o) as n from twice, (select unnest(range(0, 8)) as o) group by rn),
m as (select w.rn, doc_id, lang, source, cast(len(words) as bigint) as n_words,
  cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(len(lines) as bigint) as n_lines,
  cast(coalesce(c.n, 0) as bigint) as n_repeat_words from w left join covered c on c.rn = w.rn),
r as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  n_symbols * 10000 // greatest(word_chars, 1) as symbol_rate, n_dup_lines * 10000 // greatest(n_lines, 1) as dup_rate,
  word_chars * 1000 // greatest(n_words, 1) as word_length from m),
u as (select lang, source, 'symbol_rate' as measure, symbol_rate as v from r where not base_failed
  union all select lang, source, 'dup_rate', dup_rate from r where not base_failed
  union all select lang, source, 'word_length', word_length from r where not base_failed),
b as (select lang, source, measure, v - v % cast(pow(2, greatest(length(bin(v)) - 7, 0)) as bigint) as bucket from u),
s as (select 0 as lvl, lang, source, measure, bucket, count(*) as n from b group by all
  union all select 1, lang, null, measure, bucket, count(*) from b group by all
  union all select 2, null, null, measure, bucket, count(*) from b group by all),
c as (select *, sum(n) over (partition by lvl, lang, source, measure order by bucket) as upto,
  sum(n) over (partition by lvl, lang, source, measure) as total from s),
q as (select lvl, lang, source, measure, max(total) as total, min(bucket) filter (upto >= ceil(total * 0.25)) as q25,
  min(bucket) filter (upto >= ceil(total * 0.5)) as q50, min(bucket) filter (upto >= ceil(total * 0.75)) as q75
  from c group by all),
f as (select lvl, lang, source, max(total) as total,
  max(q50 + 6 * abs(q50 - q25) + 200) filter (measure = 'symbol_rate') as high_symbol_rate,
  max(q50 + 6 * abs(q50 - q25) + 7000) filter (measure = 'dup_rate') as high_dup_rate,
  max(q50 + 6 * abs(q50 - q75) + 1500) filter (measure = 'word_length') as high_word_length,
  max(q50 - 6 * abs(q50 - q25) - 1500) filter (measure = 'word_length') as low_word_length from q group by all),
t as (select r.*, case when o.total >= 100 then o.lvl when l.total >= 100 then l.lvl else 2 end as lvl
  from r left join f o on o.lvl = 0 and o.lang is not distinct from r.lang and o.source is not distinct from r.source
  left join f l on l.lvl = 1 and l.lang is not distinct from r.lang)
select t.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(symbol_rate <= high_symbol_rate, true) and coalesce(dup_rate <= high_dup_rate, true)
  and coalesce(word_length <= high_word_length, true) and coalesce(word_length >= low_word_length, true) as kept
from t left join f on f.lvl = t.lvl and (t.lvl = 2 or f.lang is not distinct from t.lang)
  and (t.lvl > 0 or f.source is not distinct from t.source)
"""

_OP4_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2') as body,
  replace(replace(replace(replace(role, '\', '\0'), '###', '\1'), '</turn>', '\2'), ':', '\3') as head from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(4 + length(head) + 2 + length(body) + 8) as bigint) as formatted_chars
from e group by conv_id
"""

#: CTE ``crc``: the table of CRC-32; _crc32(x) is the unsigned CRC-32 of the text x in UTF-8.
_CRC_TABLE = """
crc as (select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as tab
  from (select unnest(range(256)) as i))"""


def _crc32(x: str) -> str:
    digit = "strpos('0123456789ABCDEF', substr(hex(encode({x})), {at}, 1)) - 1"
    byte = f"({digit.format(x=x, at='2 * k + 1')}) * 16 + {digit.format(x=x, at='2 * k + 2')}"
    return (f"xor(list_reduce(list_transform(range(octet_length(encode({x}))), lambda k: {byte}), "
            f"lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP11_SQL = f"""
with recursive {_CRC_TABLE.strip()},
o as (select concat(coalesce(cast(doc_id as varchar), ''), ':', run) as tagged, run from (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), {_AZ}) as run from documents)),
h as (select run, {_crc32('tagged')} as h from o, crc),
w as (select case when h % 97 = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2)
  else run end as word from h),
v as (select word, count(*) as n from w where length(word) >= 5 group by word having count(*) >= 3),
gap as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word))) as i from v)),
link as (select a.word, b.word as near, b.n as near_n from gap a join gap b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select g.word, v.word, v.n from gap g join v on g.rest = v.word
  union select v.word, g.word, g.n from gap g join v on g.rest = v.word),
best as (select word, count(*) as n_near, first(struct_pack(w := near, n := near_n) order by near_n desc, near) as b from link group by word),
f as (select v.word, case when b.n >= 2 * v.n then b.w end as form, v.n, coalesce(n_near, 0) as n_near,
  case when b.n >= 2 * v.n then b.n end as form_n from v left join best on best.word = v.word),
up as (select word, word as at from f union all select up.word, f.form from up join f on f.word = up.at where f.form is not null)
select f.word, f.form, up.at as root, f.n, f.n_near, f.form_n from f join up on up.word = f.word join f e on e.word = up.at and e.form is null
"""

_OP12_FIELDS = " || ".join(f"coalesce(concat(octet_length(encode(cast({c} as varchar))), ':', cast({c} as varchar)), '-')"
                           for c in ("doc_id", "source", "lang", "n_chars", "{text}"))

_OP12_SQL = f"""
with recursive {_CRC_TABLE.strip()},
leaf as (select doc_id, source, sha256({_OP12_FIELDS.format(text="text")}) as leaf,
  case when doc_id is not null and {_crc32('cast(doc_id as varchar)')} % 5 = 0 then sha256({_OP12_FIELDS.format(text=f"translate(text, {_AZ})")})
  else sha256({_OP12_FIELDS.format(text="text")}) end as got from documents, crc),
place as (select row_number() over () as id, doc_id, source, leaf, got, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx from leaf),
low as (select source, 0 as lvl, idx, leaf as hash, count(*) over (partition by source) as n from place
  union all select source, any_value(lvl) + 1, idx // 16, sha256(string_agg(hash, '' order by idx)), (any_value(n) + 15) // 16
  from low where n > 1 group by source, idx // 16),
sub as (select source, hash as subroot, row_number() over (order by encode(source) nulls first) - 1 as idx, count(*) over () as n from low where n = 1),
top as (select 0 as lvl, idx, subroot as hash, n from sub
  union all select any_value(lvl) + 1, idx // 16, sha256(string_agg(hash, '' order by idx)), (any_value(n) + 15) // 16 from top where n > 1 group by idx // 16),
node as (select source, false as up, lvl, idx, hash, n from low union all select null, true, lvl, idx, hash, n from top),
run as (select source, up, lvl, idx // 16 as run, list(hash order by idx) as items from node where n > 1 group by all),
climb as (select p.id, p.source, l.n = 1 as up, 0 as lvl, case when l.n = 1 then s.idx else p.idx end as idx, p.got as folded, '' as proof,
    case when l.n = 1 then s.n else l.n end as n
    from place p join low l on l.lvl = 0 and l.idx = p.idx and l.source is not distinct from p.source join sub s on s.source is not distinct from p.source
  union all select c.id, c.source, c.up or c.n <= 16, case when not c.up and c.n <= 16 then 0 else c.lvl + 1 end,
    case when not c.up and c.n <= 16 then s.idx else c.idx // 16 end,
    sha256(array_to_string(r.items[:c.idx % 16], '') || c.folded || array_to_string(r.items[c.idx % 16 + 2:], '')),
    c.proof || array_to_string(r.items[:c.idx % 16], '') || array_to_string(r.items[c.idx % 16 + 2:], ''),
    case when not c.up and c.n <= 16 then s.n else (c.n + 15) // 16 end
    from climb c join sub s on s.source is not distinct from c.source join run r on c.n > 1 and r.up = c.up and r.lvl = c.lvl
      and r.run = c.idx // 16 and r.source is not distinct from case when c.up then null else c.source end)
select p.doc_id, p.leaf, s.subroot, t.hash as root, sha256(c.proof) as proof_sha256, c.folded as folded_root, c.folded = t.hash as verified
from climb c join place p on p.id = c.id join sub s on s.source is not distinct from p.source join top t on t.n = 1 where c.up and c.n = 1
"""

_OP13_SQL = f"""
with d as (select row_number() over () as rn, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bw as (select distinct item_id, least(len(w), 10) as m, list_slice(w, i, i + least(len(w), 10) - 1) as k
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
ms as (select distinct m from bw),
dw as (select rn, m, i, list_slice(w, i, i + m - 1) as k from (select rn, w, m, unnest(range(1, len(w) - m + 2)) as i from d, ms where len(w) >= m)),
hit as (select rn, m, i, item_id from dw join bw using (m, k)),
words as (select rn, count(distinct i + o) as n from (select rn, i, unnest(range(m)) as o from (select distinct rn, m, i from hit)) group by rn),
items as (select rn, count(*) as n, string_agg(item, ',' order by item) as ids
  from (select distinct rn, cast(item_id as varchar) as item from hit where item_id is not null) group by rn)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (rn) left join items using (rn)
"""

ORACLE_SQL = {"op1_quality": _OP1_SQL, "op4_chat": _OP4_SQL, "op11_variants": _OP11_SQL, "op12_merkle": _OP12_SQL,
              "op13_decontamination": _OP13_SQL}
