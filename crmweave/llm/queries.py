"""The registered query of each operator: production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.llm import conversations, decontaminate, language, licences, lines, mixing, neardup, repeats, rules, shards, tokens, vecdup, whitening
from crmweave.llm.frames import table, workers_find_package
from crmweave.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
SHARDS = 16
LINE_SHINGLE = 5  # code points; at 80 %, one changed one inside a line is tolerated from 49 on


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(workers_find_package(configure(spark)), sf_dir)
        if sql is not None:
            CHECKS[name] = sql
        return function

    return add


def vocabulary() -> str:
    """The byte-level vocabulary of the public tokenizers, which every machine has at the same place."""
    from public_tokenizers import path

    return str(path("byte_bpe_50k.json"))


@query("op1_token_file")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), vocabulary())


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.predictions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("span_from").alias("n_spans"))


@query("op3_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


RULES_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, list_aggregate(w[i : i + 4], 'string_agg', ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d)
), again as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows) where n > 1
), hit as (
  select doc_id, count(*) as n_repeat_words from (select distinct doc_id, unnest(range(i, i + 5)) as p from again) group by 1
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines
  from (select doc_id, unnest(string_split(body, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]') group by 1
), counts as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    length(regexp_replace(body, '\P{Lu}', '', 'g'))::bigint as n_capitals,
    length(regexp_replace(body, '[^!]', '', 'g'))::bigint as n_shouts
  from d left join hit using (doc_id) left join lines using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > n_words or 2 * n_capitals > word_chars
       or 2 * n_shouts > n_words or 2 * n_dup_lines > n_lines or word_chars < 2 * n_words or word_chars > 40 * n_words) as kept
from counts
"""


@query("op4_quality_rules", RULES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_fuzzy_lines")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents"), width=LINE_SHINGLE)


@query("op6_licences")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.findings(table(spark, sf_dir, "documents"))


HITS_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item, w[i : i + 9] as g, len(w[i : i + 9]) as n
  from (select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from b where len(w) > 0)
), grams as (
  select doc_id, i, w[i : i + n - 1] as g, n
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d), (select distinct n from windows) where i + n - 1 <= len(w)
), found as (select doc_id, i, n, item from grams join windows using (g, n)),
hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as p from found) group by 1),
items as (
  select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as s
  from (select distinct doc_id, item from found) group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(s, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""


@query("op7_decontamination", HITS_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(
        "span_from", "span_to"
    )


@query("op8_suffix_repeats")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cleaned(table(spark, sf_dir, "documents"))


@query("op9_near_duplicates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.linked(table(spark, sf_dir, "documents"))


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_rows(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op12_embedding_duplicates")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdup.linked(table(spark, sf_dir, "embeddings"))


@query("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.shared_starts_trie(table(spark, sf_dir, "conversations"))
