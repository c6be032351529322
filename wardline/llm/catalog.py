"""The package's queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import alignment, chat, decontaminate, embeddings, jaccard, packing, spelling, suffixes, token_counts, toxicity, url_rules, warc, wavelet
from wardline.llm.common import Scratch, prepare
from wardline.llm.tokens import default_path, definition

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    """Register ``fn(spark, table, ...)``, run over whole tables."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), *[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_wavelet_shards", "documents")
def op1(spark, docs):
    return wavelet.token_digests(spark, docs, definition(default_path()))


@query("op3_token_counts", "documents")
def op3(spark, docs):
    return token_counts.count_tokens(docs, Scratch(spark, "token-counts"), definition(default_path()))


@query("op6_concat_and_cut", "documents")
def op6(spark, docs):
    return packing.pieces(packing.pack(docs, Scratch(spark, "packing"), definition(default_path())))


OP2_SQL = r"""
with words as (
    select doc_id, unnest(w) as word, unnest(range(len(w))) as pos
    from (
        select doc_id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
        from documents
    )
), items as (
    select item_id, len(w) as n_words, unnest(w) as word, unnest(range(len(w))) as pos
    from (
        select item_id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
        from benchmark
    )
), same as (
    select doc_id, item_id, n_words, d.pos - i.pos as shift, i.pos as pos
    from words d join items i using (word)
), placed as (
    select doc_id, item_id, n_words, shift,
        count(*) over (partition by doc_id, item_id, shift) as n_matched,
        count(*) over (partition by doc_id, item_id, shift order by pos range between current row and least(16, n_words) - 1 following) as near
    from same
), found as (
    select *
    from placed
    where near >= least(16, n_words) - case when n_words >= 16 then 3 when n_words >= 8 then n_words // 7 else 0 end
)
select doc_id, item_id, max(n_words)::int as n_words, max(n_matched)::int as n_matched,
    greatest(0, -max((n_matched, -shift))[2])::int as doc_word
from found
group by doc_id, item_id
"""


@query("op2_spaced_seeds", "documents", "benchmark", sql=OP2_SQL)
def op2(spark, docs, items):
    return decontaminate.contaminated(docs, items)


@query("op4_weak_supervision", "documents", "labels")
def op4(spark, docs, labels):
    return toxicity.toxicity(docs, labels, Scratch(spark, "toxicity"))


@query("op5_jaccard_tiles", "documents")
def op5(spark, docs):
    return jaccard.near_duplicates(docs, Scratch(spark, "jaccard"))


OP7_SQL = r"""
with urls as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from pages
), rules(rule, verdict) as (
    values ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')
), fits as (
    select distinct host, path, rule, verdict
    from urls, rules
    where (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
        and starts_with(path, substr(rule, strpos(rule, '/')))
), best as (
    select host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
    from fits
    group by host, path
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from urls left join best using (host, path)
"""


@query("op7_url_rules", "pages", sql=OP7_SQL)
def op7(spark, pages):
    return url_rules.judge(pages)


@query("op8_itq_vectors", "embeddings")
def op8(spark, vectors):
    return embeddings.near_vectors(vectors, Scratch(spark, "vectors"))


@query("op9_two_stage_suffixes", "documents")
def op9(spark, docs):
    passages = suffixes.PASSAGE_WORDS, suffixes.PASSAGE_GRAM
    return suffixes.removal_digests(docs, Scratch(spark, "suffixes"), passages=passages)


OP10_SQL = """
with read as (
    select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), firsts as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first
    from read
)
select page_id, payload_bytes, payload_digest,
    case when first is not null and first is distinct from page_id then 'revisit' else 'response' end as record_type,
    case when first is not null and first is distinct from page_id then first end as refers_to
from firsts
"""


@query("op10_warc_index", "pages", sql=OP10_SQL)
def op10(spark, pages):
    found = warc.captures(pages, Scratch(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations
    union all
    select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), shown as (
    select *, length(regexp_replace(text, '([\[<]/?)(\\*)((?:INST|SYS|ROLE|TEXT)\]|s>)', '\1\\\2\3', 'g')) as chars,
        length(regexp_replace(role, '([\[<]/?)(\\*)((?:INST|SYS|ROLE|TEXT)\]|s>)', '\1\\\2\3', 'g')) as role_chars
    from rows
), joined as (
    select conv_id, count(*)::bigint as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as whole,
        coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '') as loss,
        sum(chars + case role when 'user' then 15 when 'system' then 13 when 'assistant' then 7 else 19 + role_chars end)::bigint as formatted_chars
    from shown
    group by conv_id
)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, formatted_chars
from joined
"""


@query("op11_grammar_round_trip", "conversations", sql=OP11_SQL)
def op11(spark, chats):
    return chat.digests(chat.write_chats(chat.with_probe(chats), Scratch(spark, "chats")))


@query("op12_alignment_counts", "documents")
def op12(spark, docs):
    return alignment.align(docs, Scratch(spark, "alignment"), definition(default_path("byte_bpe_50k.json")), alignment.default_model())


@query("op13_spelling_variants", "documents")
def op13(spark, docs):
    return spelling.variants(docs, Scratch(spark, "spelling"))
