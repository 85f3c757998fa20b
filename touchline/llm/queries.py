"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, langid, line_dedup, mixing, packing, secrets, sharding, simhash, topk, toxicity, trie, xent
from .tables import held_out

#: Production parameters of the placement query.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def tokenizer_path(file: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(file))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best vectors for every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out("doc_id")))
    told = toxicity.score(docs, model)
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and dropped, and a digest of what stays, for every document."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), stats="lines")
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out("doc_id")))
    told = langid.identify(docs, model)
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds a passage."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document: labelled good ones are the target, all are the background."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    # Always by shuffle: the labels grow with the documents, and so does the way they are joined.
    marked = docs.join(good.hint("shuffle_hash"), F.col("doc_id") == F.col("good_id"), "left").withColumn("good", F.col("good_id").isNotNull())
    return xent.score(docs, xent.train(marked, "text", "good"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets of every document."""
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of its source takes."""
    plan = mixing.planned(table(spark, sf_dir, "documents"), ["doc_id"])
    return plan.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the words that set it apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that borrow their first turns from others."""
    turns = trie.numbered(table(spark, sf_dir, "conversations"))
    return trie.trie(*trie.borrowed_heads(turns, trie.lengths(turns)))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_topk,
        op3_toxicity,
        op4_packing,
        op5_line_dedup,
        op6_language_id,
        op7_sharding,
        op8_decontamination,
        op9_lm_scoring,
        op10_secret_scan,
        op11_mixing,
        op12_divergence,
        op13_prefix_trie,
    )
}
ORACLE: dict[str, str] = {}

ORACLE["op2_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda c: floor(1024 * cast(c as double))) as q from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE["op5_line_dedup"] = f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
e as (select doc_id, i, lines[i] as line from d, unnest(range(1, len(lines) + 1)) as t(i)),
k as (select *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from e),
r as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
j as (select k.*, coalesce(k.doc_id <> r.first, false) as gone from k left join r on k.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from j group by doc_id"""


def _sql_hits(order: int) -> str:
    _, pattern, group, least = secrets.KINDS[order]
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
  select doc_id, source, {order} as kind, start, start + length(hit) as stop, value from (
    select doc_id, source, hit, value, sum(length(gap) + coalesce(length(before), 0)) over (
      partition by doc_id order by i) as start
    from (select doc_id, source, i, hits[i] as hit, vals[i] as value, gaps[i] as gap, hits[i - 1] as before
      from (select doc_id, source, regexp_extract_all(text, {quoted}, 0) as hits,
          regexp_extract_all(text, {quoted}, {group}) as vals, string_split_regex(text, {quoted}) as gaps
        from documents where regexp_matches(text, {quoted})),
      unnest(range(1, len(hits) + 1)) as t(i)))
  where length(value) >= {least}"""


_NAMES = "['" + "', '".join([k[0] for k in secrets.KINDS] + [secrets.LIVE]) + "']"
_SPAN = f"({_NAMES})[kind + 1] || ':' || start || ':' || stop"
ORACLE["op10_secret_scan"] = f"""
with h as ({" union all ".join(map(_sql_hits, range(len(secrets.KINDS))))}),
o as (select value as held, count(distinct coalesce(source, '')) as owners from h group by 1),
live as (
  select distinct doc_id, stop - length(value) as start, {len(secrets.KINDS)} as kind, stop, value from h join o on held = value
  where owners < {secrets.EXAMPLE_OWNERS} and regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
    and len(list_distinct(string_split(value, ''))) >= {secrets.LIVE_CHARACTERS}),
b as (select doc_id, {", ".join(f"count(*) filter (where kind = {k}) as n_{n[0]}" for k, n in enumerate(secrets.KINDS))},
  string_agg({_SPAN}, ',' order by start, kind) as spans from h group by 1),
a as (select doc_id, string_agg({_SPAN}, ',' order by start, kind) as spans, count(*) filter (where kind = {len(secrets.KINDS)}) as n_live
  from (select doc_id, kind, start, stop from h union all select doc_id, kind, start, stop from live) group by 1)
select d.doc_id, {", ".join(f"coalesce(n_{n[0]}, 0) as n_{n[0]}" for n in secrets.KINDS)},
  sha256(coalesce(b.spans, '')) as base_sha256, coalesce(a.spans, '') as spans, coalesce(n_live, 0) as n_live
from documents d left join b on b.doc_id = d.doc_id left join a on a.doc_id = d.doc_id"""

_WEIGHT = f"[{', '.join(map(str, mixing.WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1]"
# Sources leave in the order of their limit over their weight; the first level that the next source does not reach holds.
ORACLE["op11_mixing"] = f"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
    md5(concat_ws('|', coalesce(cast(doc_id as varchar), ''), coalesce('+' || source, '-'), md5(coalesce(text, '')))) as document
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size, {_WEIGHT} as weight from d group by source),
o as (
  select *, coalesce(sum({mixing.MOST} * source_size) over w, 0) as used, sum(weight) over () - coalesce(sum(weight) over w, 0) as rest,
    sum(source_size) over () as total
  from s window w as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
l as (
  select {mixing.SHARE.numerator} * total - {mixing.SHARE.denominator} * used as num, {mixing.SHARE.denominator} * rest as den from o
  where {mixing.MOST} * source_size * {mixing.SHARE.denominator} * rest > weight * ({mixing.SHARE.numerator} * total - {mixing.SHARE.denominator} * used)
  order by used, rest desc limit 1),
t as (
  select source, source_size, case when den is null or weight * num >= {mixing.MOST} * source_size * den then cast({mixing.MOST} * source_size as double)
    else cast(weight as double) * cast(num as double) / cast(den as double) end as target
  from s left join l on true),
n as (select *, row_number() over (partition by document) as copy from d),
r as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0.0::double end as rate,
    cast(cast('0x' || substr(md5(concat_ws('|', document, '{mixing.SEED}', cast(copy as varchar))), 1, {mixing.DRAW_BITS // 4}) as bigint) as double) / {1 << mixing.DRAW_BITS}::double as draw
  from n join t on n.source is not distinct from t.source)
select doc_id, size, source_size, target, size * cast(floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end as bigint) as taken from r"""

# The checksum is computed bit by bit; a prefix is the joined digests of its turns.
_CRC32 = """xor(list_reduce(list_transform(string_split(cast({} as varchar), ''), lambda ch: cast(ascii(ch) as bigint)),
    lambda crc, byte: list_reduce(range(8), lambda v, i: case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, xor(crc, byte)),
    4294967295), 4294967295)"""
ORACLE["op13_prefix_trie"] = f"""
with t as (
  select conv_id as c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest,
    cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as words
  from conversations where conv_id is not null),
k as (select *, row_number() over (partition by c order by turn nulls first, digest) as k from t),
n as (select c, max(k) as n, {_CRC32.format("c")} % {trie.MOST_BORROWED + 1} as h from k group by c),
m as (select n.*, least(n.h, coalesce(b.n, 0)) as taken from n left join n b on b.c = n.c - n.c % {trie.GROUP}),
e as (
  select k.c, k - h + taken as d, digest, words from k join m on k.c = m.c where k > h
  union all select m.c, k, digest, words from m join k on k.c = m.c - m.c % {trie.GROUP} and k <= taken),
a as (
  select c, d, words, string_agg(digest, ',') over (partition by c order by d) as node,
    coalesce(string_agg(digest, ',') over (partition by c order by d rows between unbounded preceding and 1 preceding), '') as parent
  from e union all select c, 0, 0, '', null from m),
l as (select c, max(d) as last from a group by c),
g as (
  select node, d, parent, any_value(words) as words, min(a.c) as least, count(*) as n,
    sha256(coalesce(string_agg(cast(a.c as varchar), ',' order by a.c) filter (where d = last), '')) as ends_sha256
  from a join l on a.c = l.c group by node, d, parent),
f as (select parent, count(*) as kids from g group by parent),
s as (
  select a.node, count(*) filter (where f.kids is null) as leaves, sum((g.n - 1) * g.words) as saved
  from g join a on a.c = g.least and a.d <= g.d left join f on f.parent = g.node group by a.node)
select g.least as conv_id, cast(g.d as bigint) as depth, p.least as parent_conv_id, g.n as n_convs, coalesce(f.kids, 0) as n_children,
  s.leaves as n_leaves, cast(s.saved as bigint) as saved_tokens, g.ends_sha256
from g join s on s.node = g.node left join f on f.parent = g.node left join g p on p.node = g.parent"""

_SHARE = f"1 + cast({divergence.SCALE}::hugeint * ({{n}} + 2) // ({{all_n}} + 2 * v) as bigint)"
ORACLE["op12_divergence"] = f"""
with d as (select row_number() over () as id, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (
  select id, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
k as (select lang, term, count(*) as n from w group by lang, term having count(distinct id) >= {divergence.LEAST_DOCS}),
l as (select lang, count(*) as v, sum(n)::hugeint as all_n from k group by lang),
c as (select w.lang, w.source, w.term, count(*) as n from w join k on w.lang = k.lang and w.term = k.term group by all),
g as (select distinct lang, source from d),
x as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as total, l.v, l.all_n,
    sum(coalesce(c.n, 0)) over (partition by g.lang, g.source)::hugeint as own_n
  from g join k on g.lang = k.lang join l on l.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
y as (select lang, source, term, n, {_SHARE.format(n="n", all_n="own_n")} as p, {_SHARE.format(n="total", all_n="all_n")} as q from x),
f as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p)::hugeint * (a.p - b.p) // (a.p + b.p)) as value
  from y a join y b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(f.value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
  union all
  select lang, source, 'term', term, cast((p - q)::hugeint * (p - q) // (p + q) as bigint) from y where n > 0 and p > q),
o as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from r)
select * from o where part = 'pair' or rank <= {divergence.TOP}"""
