"""Queries of the llm operators over whole tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import bpe, decontaminate, quality, secrets, sharding, simhash, suffix_repeats, token_files, toxicity, unit_dedup
from leafmill.llm.common import read

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def op1_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_ngram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("items")


def op3_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.without_repeats(read(spark, sf_dir, "documents")).drop("removed")


def op4_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read(spark, sf_dir, "documents")).drop("rejected_by")


def op5_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


def op6_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_unit_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.deduplicated(read(spark, sf_dir, "documents")).drop("text")


def op9_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffled_shards(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash_bk_tree, op2_ngram_decontamination, op3_suffix_array_repeats, op4_rule_cascade, op5_credential_linking, op6_arrow_token_files, op7_toxic_segments, op8_unit_hashing, op9_chunked_bpe, op10_feistel_shards)}

#: A-Z to a-z and nothing else.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
with doc as (select doc_id, row_number() over () as r, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
item as (select item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
win as (select distinct item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as x
    from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from (select item_id, w, least(len(w), 10) as n from item where len(w) > 0) as q) as q),
size as (select distinct n from win),
place as (select r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as x from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, size where len(w) >= n) as q),
hit as (select p.r, p.i, p.n, v.item_id from place as p join win as v on p.x = v.x and p.n = v.n),
word as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + n)) as k from hit) as q group by r),
named as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word on doc.r = word.r left join named on doc.r = named.r
"""

#: Words are what stands between ASCII white space; windows of eight words are compared word by word.
OP4_SQL = """
with doc as (select doc_id, row_number() over () as r, coalesce(text, '') as t from documents),
words as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from doc),
place as (select r, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') as x from (select r, w, unnest(range(1, len(w) - 6)) as i from words where len(w) > 8) as q),
twice as (select r, i from (select r, i, count(*) over (partition by r, x) as n from place) as q where n > 1),
again as (select r, count(distinct k) as n from (select r, unnest(range(i, i + 8)) as k from twice) as q group by r),
base as (select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words, len(lines) as n_lines, len(list_distinct(w)) as n_distinct, len(list_filter(w, lambda x: regexp_matches(x, '\\pL'))) as n_lettered
    from words left join again on words.r = again.r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 2 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 15 * n_words or (n_lines >= 4 and 2 * n_dup_lines > n_lines) or 50 * n_distinct < n_words or 2 * n_lettered < n_words) as kept
from base
"""

def op5_sql() -> str:
    """Kinds by pattern, places by running sums, the interval join by windows, as secrets states them."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    each = []
    for k, (name, (pattern, least, group, role, base)) in enumerate(secrets.KINDS.items()):
        holds = "".join(f" and regexp_matches(m, {quoted(h)})" for h in secrets.HOLDS.get(name, ()))
        found = f"select r, regexp_extract_all(t, {quoted(pattern)}) as ms, regexp_extract_all(t, {quoted(pattern)}, {group}) as gs, regexp_split_to_array(t, {quoted(pattern)}) as bs from doc"
        rows = f"select r, i, ms[i] as m, gs[i] as g, bs[i] as b from (select *, unnest(range(1, len(ms) + 1)) as i from ({found}) as q) as q"
        each.append(f"select r, {k} as k, i, length(b) as gap, length(m) as n, case when length(g) >= {least}{holds} then '{role}' end as role0, {str(base).lower()} as base0 from ({rows}) as q")
    before = "over (partition by r order by s, k, e rows between unbounded preceding and 1 preceding)"
    after = "over (partition by r order by s, k, e rows between 1 following and unbounded following)"
    roles = ("identifier", "secret", "endpoint")
    last = ", ".join(f"max({{'e': e, 's': s}}) filter (where role = '{x}') {before} as last_{x}, min({{'s': s, 'e': e}}) filter (where role = '{x}') {after} as next_{x}" for x in roles)
    back, ahead = (lambda x: f"coalesce(s - last_{x}.e, 1 << 30)"), (lambda x: f"coalesce(next_{x}.s - e, 1 << 30)")
    near = ", ".join(f"case when least({back(x)}, {ahead(x)}) <= {secrets.SCOPE} then case when {back(x)} <= {ahead(x)} then last_{x}.s else next_{x}.s end end as near_{x}" for x in roles)
    kinds = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    told = lambda when: f"coalesce(string_agg({kinds}[k + 1] || ':' || s || ':' || e, ',' order by s, k, e) filter (where reported and {when}), '')"
    count = lambda k: f"cast(count(*) filter (where reported and k = {k}) as bigint)"
    shown = lambda x: f"coalesce(cast(near_{x} as varchar), '-')"
    return f"""
with doc as (select doc_id, row_number() over () as r, coalesce(text, '') as t from documents),
found as ({' union all '.join(each)}),
placed as (select r, k, n, role0, base0, gap + coalesce(sum(gap + n) over (partition by r, k order by i rows between unbounded preceding and 1 preceding), 0) as s from found),
good as (select r, k, cast(s as bigint) as s, cast(s as bigint) + n as e, role0, base0 as base from placed where role0 is not null),
part as (select r, k, s, e, base, value, case when not value then role0 end as role from (select *, k = 4 and coalesce(max(e) filter (where k = 3) {before} > s, false) as value from good) as q),
beside as (select *, coalesce(max(e) filter (where base) {before} > s, false) or coalesce(min(s) filter (where base) {after} < e, false) as covered, {last} from part),
linked as (select *, {near} from beside),
marked as (select *, base or (not covered and not value and case when role = 'secret' then near_identifier is not null or near_endpoint is not null else near_secret is not null end) as reported from linked),
told as (select r, {count(0)} as n_assign, {count(1)} as n_access, {count(2)} as n_hex, {told('k < 3')} as base_spans, {told('true')} as spans,
    coalesce(string_agg(s || ':' || {shown('identifier')} || ':' || {shown('endpoint')}, ',' order by s) filter (where reported and role = 'secret' and (near_identifier is not null or near_endpoint is not null)), '') as links
    from marked group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(links, '') as links
from doc left join told on doc.r = told.r
"""


#: The others rest on XXH64, byte strings, learnt scores, BPE or networks of bits, which DuckDB cannot express; tests/llm holds them against plain Python.
ORACLES: dict[str, str] = {"op2_ngram_decontamination": OP2_SQL, "op4_rule_cascade": OP4_SQL, "op5_credential_linking": op5_sql()}
