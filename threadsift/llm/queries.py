"""The queries opN_<name>: each applies an operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.llm import chat, fingerprints, jaccard, language, lines, negatives, packing, resharding, suffixes, toxicity, trie, warc, winnowing
from threadsift.llm.tables import ship, table
from threadsift.sources.scratch import scratch_folder


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = scratch_folder(spark, "warc")
    warc.write_archives(warc.page_records(table(spark, sf_dir, "pages")), path)
    read = warc.read_archives(spark, path)
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    return read.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"), "error",
    )


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h) as payload_bytes, sha256(h) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to,
  cast(null as varchar) as error
from f
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    packed = packing.pack(pieces)
    return packed.pieces.withColumn("lower_bound", F.lit(packed.bound).cast("long"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = jaccard.near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(~toxicity.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.REJECT_SCORE).cast("int").alias("predicted"),
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    left = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations"))
    spoken = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(spoken).alias("text"),
    )
    return chat.read_back(chat.format_turns(turns.unionByName(own)))


OP6_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (select *, regexp_replace(replace(role, '\', '\\'), '([<\[])(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2', 'g') as r,
  regexp_replace(replace(text, '\', '\\'), '([<\[])(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2', 'g') as t from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(r) + length(t) + 20) as bigint) as formatted_chars
from marked group by conv_id
"""


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
with recursive lowered as (select doc_id, row_number() over () as r,
  list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
items as (select item_id,
  list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from benchmark),
sized as (select *, least(len(ws), 10) as size from items where len(ws) > 0),
wanted as (select distinct item_id, size, list_aggregate(ws[i:i + size - 1], 'string_agg', ' ') as w
  from (select *, unnest(range(1, len(ws) - size + 2)) as i from sized)),
sizes as (select distinct size from wanted),
windows as (select r, size, i, list_aggregate(ws[i:i + size - 1], 'string_agg', ' ') as w
  from (select r, ws, size, unnest(range(1, len(ws) - size + 2)) as i from lowered, sizes where len(ws) >= size)),
hits as (select r, i, windows.size, item_id from windows join wanted on windows.w = wanted.w and windows.size = wanted.size),
hit_words as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + size)) as k from hits) group by r),
found as (select r, count(distinct item_id) as n_items,
  sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as items_sha256 from hits group by r)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from lowered left join hit_words using (r) left join found using (r)
"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = language.train(docs.filter(~held_out))
    found = language.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return fingerprints.edited_neighbours(table(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


#: Edit distances of DuckDB count bytes, so accented letters of the corpus become single bytes first.
OP10_SQL = r"""
with parts as (select doc_id, text, unnest(string_split(text, chr(10))) as line,
  generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null),
taking as (select * from parts where length(line) >= 32 or len(list_filter(string_split_regex(line, '[ \t\x0B\f\r]+'), lambda x: x <> '')) >= 3),
named as (select line, min(row(doc_id is null, doc_id, pos)) as first from taking group by line),
bytes as (select *, translate(line, 'äöüßéèêçàùôîñóíúáâëïûœÄÖÜÉÈÊÇÀÙÔÎÑÓÍÚÁ', '0123456789@#~^=<>{}[]|ABCDEFGHIJKLMNOP') as b,
  length(line) as n from named where length(line) >= 32),
near as (select distinct p.line from bytes p join bytes q on q.n between p.n - 2 and p.n + 2 and q.first < p.first
  and (substr(p.line, 1, q.n // 3) = substr(q.line, 1, q.n // 3) or right(p.line, q.n // 3) = right(q.line, q.n // 3)
    or levenshtein(substr(p.b, 1, 24), substr(q.b, 1, 24)) <= 2)
  where levenshtein(p.b, q.b) <= 2),
judged as (select parts.doc_id, parts.pos, parts.line, coalesce(near.line is not null
    or (named.line is not null and row(parts.doc_id is null, parts.doc_id, parts.pos) > named.first), false) as gone
  from parts left join named using (line) left join near on near.line = parts.line)
select d.doc_id, coalesce(count(j.pos), 0) as n_lines, coalesce(sum(j.gone::int), 0)::bigint as n_removed,
  sha256(coalesce(string_agg(j.line, chr(10) order by j.pos) filter (where not j.gone), '')) as kept_sha256
from documents d left join judged j on j.doc_id = d.doc_id group by d.doc_id
"""


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: CRC-32 byte by byte and bit by bit; subtrees through the first members of the nodes below.
OP11_SQL = r"""
with turns as (select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (select *, row_number() over (partition by c order by turn nulls first, role, text) - 1 as j from turns),
convs as (select distinct c, c - c % 20 as r, xor(list_reduce(list_prepend(4294967295::ubigint,
  list_transform(string_split(cast(c as varchar), ''), lambda x: ord(x)::ubigint)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint) % 4 as h from turns),
seq as (select convs.c, 0 as half, j, role, text from convs join own on own.c = convs.r and own.j < convs.h
  union all select convs.c, 1, j, role, text from convs join own on own.c = convs.c and own.j >= convs.h),
rebuilt as (select c, row_number() over (partition by c order by half, j) as d, role, text from seq),
named as (select c, d, text, md5(string_agg(md5(role) || md5(text), '') over (partition by c order by d)) as k from rebuilt),
rooted as (select * from named union all select c, 0, '', '' from convs),
lengths as (select c, max(d) as n from rooted group by c),
nodes as (select d, k, min(c) as conv_id, count(*) as n_convs,
  len(list_filter(string_split_regex(min(text), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words from rooted group by d, k),
up as (select x.d, x.k, y.k as pk from nodes x left join rooted y on y.c = x.conv_id and y.d = x.d - 1),
children as (select pk, d - 1 as d, count(*) as n_children from up where d > 0 group by pk, d),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children on children.pk = nodes.k and children.d = nodes.d),
totals as (select r.d, r.k, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * words) as saved
  from full_nodes f join rooted r on r.c = f.conv_id and r.d <= f.d group by r.d, r.k),
ends as (select r.d, r.k, sha256(string_agg(cast(r.c as varchar), ',' order by r.c)) as e from rooted r join lengths on r.c = lengths.c and r.d = n group by r.d, r.k)
select f.conv_id, f.d as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, cast(n_leaves as bigint) as n_leaves,
  cast(saved as bigint) as saved_tokens, coalesce(e, sha256('')) as ends_sha256
from full_nodes f join up using (d, k) join totals t using (d, k) left join nodes p on p.k = up.pk and p.d = f.d - 1 left join ends using (d, k)
"""


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long").alias("label")
    rows = table(spark, sf_dir, "embeddings").filter(negatives.usable(F.col("label"), F.col("embedding")))
    return negatives.hard_negatives(rows.select("vec_id", label, negatives.whole_numbers(F.col("embedding")).alias("q")))


OP12_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings where label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.vec_id as anchor, b.vec_id as other, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as s
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
pos as (select * from (select *, row_number() over (partition by anchor order by s desc, other) as k from scores where same) where k <= 5),
neg as (select p.anchor, p.other as positive, p.s as ps, n.other as negative, n.s as ns,
  row_number() over (partition by p.anchor, p.other order by n.s desc, n.other) as rank
  from pos p join scores n on n.anchor = p.anchor and not n.same and 50 * p.s <= 100 * n.s and 100 * n.s <= 95 * p.s)
select anchor as anchor_id, positive as positive_id, cast(rank as int) as rank, negative as negative_id, ps as positive_score, ns as negative_score
from neg where rank <= 3
"""


#: Folders of the layout that op13 starts from: documents by a hash of their source, so one of them holds a third or more.
OLD_SHARDS, SHARDS = 6, 8


def op13_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    root = scratch_folder(spark, "layout")
    by_source = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS))
    schema = resharding.store(table(spark, sf_dir, "documents"), by_source, root)
    found = resharding.read_layout(spark, resharding.reshard(spark, root, schema, SHARDS))
    return found.select(
        "doc.doc_id", "size", F.crc32(F.coalesce("doc.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(resharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"),
    )


QUERIES = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_jaccard": op3_jaccard,
    "op4_toxicity": op4_toxicity,
    "op5_suffixes": op5_suffixes,
    "op6_chat": op6_chat,
    "op7_winnowing": op7_winnowing,
    "op8_language": op8_language,
    "op9_fingerprints": op9_fingerprints,
    "op10_lines": op10_lines,
    "op11_trie": op11_trie,
    "op12_negatives": op12_negatives,
    "op13_resharding": op13_resharding,
}
ORACLE = {"op1_warc": OP1_SQL, "op6_chat": OP6_SQL, "op7_winnowing": OP7_SQL, "op10_lines": OP10_SQL, "op11_trie": OP11_SQL, "op12_negatives": OP12_SQL}
