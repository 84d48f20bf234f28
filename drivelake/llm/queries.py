"""The registered queries of this subpackage and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.llm import chosen_path, filter_audit, html_text, license_scan, merkle, ngram_join, packing, pair_bpe, quality_rules, sanitise, secret_scan, token_file, top_products
from drivelake.llm.common import shared_path, table


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "token-file")
    token_file.write_corpus(spark, table(spark, sf_dir, "documents"), out)
    return token_file.read_corpus(spark, out, digest=True)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, docs = shared_path(spark, "ledger"), table(spark, sf_dir, "documents")
    secret_scan.scan(spark, docs, ledger)
    return secret_scan.findings(spark, docs, ledger)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op4_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(spark, table(spark, sf_dir, "embeddings"))


def op5_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bpe.digests(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files source/thousands/tens/doc_id.txt; every tenth is its directory's LICENSE, every thousandth that of the directory above."""
    row, part = F.col("doc_id"), lambda n: F.floor(F.col("doc_id") / n).cast("string")
    name = F.when(row % 10 == 0, "LICENSE").otherwise(F.concat(row.cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.lit("source"), part(1000), F.when(row % 1000 != 0, part(10)), name)
    return license_scan.scan(spark, table(spark, sf_dir, "documents"), F.when(row.isNotNull(), path))


def op8_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.findings(spark, table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), digest=True)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(spark, table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verification(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_file": op1_token_file,
    "op2_secret_scan": op2_secret_scan,
    "op3_html_text": op3_html_text,
    "op4_top_products": op4_top_products,
    "op5_pair_bpe": op5_pair_bpe,
    "op6_ngram_join": op6_ngram_join,
    "op7_license_scan": op7_license_scan,
    "op8_sanitise": op8_sanitise,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_chosen_path": op11_chosen_path,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}
#: Words end at ASCII white space; A-Z are lower-cased alone.
_OP6_SQL = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda x: x <> '') w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) s from words),
grams as (select doc_id, unnest(s) g from sets),
overlap as (select a.doc_id x, b.doc_id y, count(*) o from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by all),
links as (select x, y from overlap join sets a on a.doc_id = x join sets b on b.doc_id = y where 100 * o >= 85 * (len(a.s) + len(b.s) - o)),
reach as (select doc_id, doc_id as r from sets union select reach.doc_id, y from reach join links on x = r)
select reach.doc_id, any_value(len(s))::bigint as n_shingles, min(r) as component_id from reach join sets on sets.doc_id = reach.doc_id group by reach.doc_id
"""

#: The same with two words and 80 of 100; a document is kept if it has its component's id.
_OP11_SQL = f"""
select *, doc_id is not distinct from component_id as kept from ({
    _OP6_SQL.replace("len(w) < 4", "len(w) < 2").replace("len(w) - 2)", "len(w))").replace("i + 3", "i + 1").replace(">= 85 *", ">= 80 *")})
"""

_OP4_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
           where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id query_id, b.vec_id, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::bigint score
      from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v))
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s qualify rank <= 5
"""

#: Every order is applied filter by filter.
_OP12_SQL = """
with docs as (select doc_id, coalesce(source, '') part, coalesce(text, '') t from documents),
firsts as (select t, min(doc_id) as lo from docs group by t),
words as (select docs.*, list_filter(regexp_split_to_array(docs.t, '[ \\x09-\\x0D]+'), lambda x: x <> '') w, coalesce(doc_id > lo, false) e from docs join firsts on firsts.t = docs.t),
known as (select doc_id, max((quality = 1)::int) good, max((toxic = 1)::int) toxic from labels where doc_id is not null group by doc_id),
fails as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
    concat(case when len(w) < 50 then 'A' else '' end, case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end,
           case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end,
           case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end, case when e then 'E' else '' end) f
  from words left join known on known.doc_id = words.doc_id),
masks as (select part, f, count(*)::bigint n, sum(good)::bigint good, sum(toxic)::bigint toxic from fails group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (select a.x || b.x || c.x || d.x || e.x o from letters a, letters b, letters c, letters d, letters e
           where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone as (select part, o, n, good, toxic, f, list_min(list_filter(list_transform(string_split(f, ''), lambda x: if(x = '', 0, strpos(o, x))), lambda i: i > 0)) as pos from masks, orders),
grid as (select part, o, step, substr(o, step, 1) x from (select distinct part from masks), orders, (select unnest([1, 2, 3, 4, 5]) step)),
steps as (select grid.part, grid.o, step, x, sum(n)::bigint docs, coalesce(sum(n) filter (pos <= step), 0)::bigint so_far, coalesce(sum(n) filter (pos = step), 0)::bigint removed,
    coalesce(sum(n) filter (pos < step and contains(f, x)), 0)::bigint redundant, coalesce(sum(n) filter (f = x), 0)::bigint unique_fails,
    coalesce(sum(good) filter (pos = step), 0)::bigint good_lost, coalesce(sum(toxic) filter (pos = step), 0)::bigint toxic_lost
  from grid join gone on gone.part = grid.part and gone.o = grid.o group by all)
select part, o as filter_order, step, docs - so_far as kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, x))::bigint as shapley from steps
"""

#: Levels by a recursive query, the CRC-32 bit by bit. Trees: one a source, then '' over the sources; an id and a leaf place a row.
_OP13_SQL = """
with recursive docs as (select *, coalesce('=' || source, '-') tree, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') low from documents),
heads as (select doc_id, tree, text, low, concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-')) head from docs),
marked as (select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) changed,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint) crc from heads),
leaves as (select doc_id, tree, leaf, case when crc % 5 = 0 then changed else leaf end held,
    row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) n from marked),
nodes as (select 0 lvl, tree, pos, leaf h, n from leaves
  union all select lvl + 1, tree, pos // 16, sha256(string_agg(h, '' order by pos)), (n + 15) // 16 from nodes where n > 1 group by lvl, tree, pos // 16, n),
subroots as (select tree, h, lvl from nodes where n = 1),
over_nodes as (select 0 lvl, row_number() over (order by tree) - 1 as pos, h, count(*) over () n from subroots
  union all select lvl + 1, pos // 16, sha256(string_agg(h, '' order by pos)), (n + 15) // 16 from over_nodes where n > 1 group by lvl, pos // 16, n),
places as (select tree, h subroot, lvl depth, row_number() over (order by tree) - 1 as pos from subroots),
climb as (select l.tree, l.pos start, 0 lvl, l.pos, l.held, '' proof, p.depth from leaves l join places p on p.tree = l.tree
  union all select c.tree, c.start, c.lvl + 1, c.pos // 16, sha256(s.l || c.held || s.r), c.proof || s.l || s.r, c.depth from climb c, lateral (
    select coalesce(string_agg(h, '' order by n.pos) filter (n.pos < c.pos), '') l, coalesce(string_agg(h, '' order by n.pos) filter (n.pos > c.pos), '') r
    from nodes n where n.tree = c.tree and n.lvl = c.lvl and n.pos // 16 = c.pos // 16) s where c.lvl < c.depth),
summit as (select max(lvl) depth, arg_max(h, lvl) root from over_nodes),
upper_climb as (select c.tree, c.start, 0 lvl, p.pos, c.held, c.proof from climb c join places p on p.tree = c.tree where c.lvl = c.depth
  union all select c.tree, c.start, c.lvl + 1, c.pos // 16, sha256(s.l || c.held || s.r), c.proof || s.l || s.r from upper_climb c, lateral (
    select coalesce(string_agg(h, '' order by n.pos) filter (n.pos < c.pos), '') l, coalesce(string_agg(h, '' order by n.pos) filter (n.pos > c.pos), '') r
    from over_nodes n where n.lvl = c.lvl and n.pos // 16 = c.pos // 16) s where c.lvl < (select depth from summit))
select l.doc_id, l.leaf, p.subroot, summit.root, sha256(u.proof) as proof_sha256, u.held as folded_root, u.held = summit.root as verified
from leaves l join places p on p.tree = l.tree join upper_climb u on u.tree = l.tree and u.start = l.pos join summit on u.lvl = summit.depth
"""

ORACLE: dict[str, str] = {"op4_top_products": _OP4_SQL, "op6_ngram_join": _OP6_SQL, "op11_chosen_path": _OP11_SQL, "op12_filter_audit": _OP12_SQL, "op13_merkle_manifest": _OP13_SQL}
