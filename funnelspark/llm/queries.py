"""The queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelspark.llm.workers import reachable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder}/{name}.parquet")


@query
def op10_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 1,024."""
    import public_tokenizers

    from funnelspark.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents by the default weights, with the words it takes of each."""
    from funnelspark.llm.mixing import pareto_mix

    mixed = pareto_mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.selectExpr(
        "doc_id",
        "mix_size as size",
        "mix_source_size as source_size",
        "mix_target as target",
        "mix_size * mix_copies as taken",
    )


@query
def op6_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal documents."""
    from funnelspark.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, folder, "documents"))


ORACLES["op6_chunk_recipes"] = r"""
with plain as (
    select doc_id, coalesce(length(text), 0) as n_points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as plain
    from documents
), ranked as (
    select *, row_number() over (partition by plain order by n_points desc, doc_id) as place
    from plain
)
select doc_id,
       first_value(doc_id) over (partition by plain order by place) as keep_id,
       count(*) over (partition by plain) as group_size,
       place = 1 as kept,
       sha256(plain) as text_sha256
from ranked
"""


@query
def op4_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one of control strings, formatted and read back; a conversation is a chain of replies."""
    from funnelspark.llm.chat import format_paths, number_messages, read_back

    said = "</s>[INST] ok [/INST]"
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], conversations.schema)
    read = read_back(format_paths(number_messages(conversations.unionByName(probe))))
    learned = "array_join(transform(messages, m -> m.learned), '')"
    return read.selectExpr(
        "conv_id",
        "cast(size(messages) as bigint) as n_turns",
        r"sha2(array_join(transform(messages, m -> concat(m.role, '\n', m.text, '\n')), ''), 256) as turns_sha256",
        f"cast(length({learned}) as bigint) as loss_chars",
        f"sha2({learned}, 256) as loss_sha256",
        "cast(length(formatted) as bigint) as formatted_chars",
    )


ORACLES["op4_reply_trees"] = r"""
with rows as (
    select conv_id, turn, role, text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), said as (
    select conv_id, turn, role, text, coalesce(role, '') as r, coalesce(text, '') as t from rows
    where conv_id is not null
), escaped as (
    select *, replace(replace(replace(replace(replace(r || chr(1) || t, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'),
                      '[INST]', '[\INST]'), '[/INST]', '[\/INST]') as e
    from said
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, role nulls first, text nulls first)) as turns_sha256,
       coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(t, '' order by turn nulls first, text nulls first) filter (r = 'assistant'), '')) as loss_sha256,
       sum(length(e) - 1 + length('<s>[INST]  [/INST]</s>'))::bigint as formatted_chars
from escaped
group by conv_id
"""


@query
def op2_ordinal_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity grade by a model fitted on the folder's labels."""
    from funnelspark.llm.toxicity import score, train

    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"))
    return score(documents, model).drop("text")


@query
def op1_hierarchical_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents have no addresses: their source is the host, and its languages are the paths."""
    from funnelspark.llm.quality import posterior_quality, train

    documents = table(spark, folder, "documents").selectExpr("doc_id", "source as host", "lang as path", "text")
    labels = table(spark, folder, "labels")
    return posterior_quality(documents, labels, train(documents, labels))


#: Dated list entries and fetch times derived from the pages' own addresses: digests give the days.
_HOST = r"lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"
_CAPTURES = f"""
    select page_id, url, {_HOST} as host, regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]*)', 1) as segment,
           1672531200 + (page_id * 2654435761) % 63072000 as fetched
    from pages
"""
_ENTRIES = """
    select host as pattern, 'block' as action, listed from listed_hosts where code % 3 = 0
    union all select host, 'remove', listed + 90 * 86400 from listed_hosts where code % 6 = 0
    union all select host, 'block', listed + 200 * 86400 from listed_hosts where code % 12 = 0
    union all select regexp_extract(host, '[^.]+[.][^.]+$', 0), 'block', 1672531200 + (code % 700) * 86400 from listed_hosts where code % 97 = 0
    union all select host || '/' || segment, 'allow', 1672531200 + (code % 500) * 86400 from listed_paths where code % 2 = 0 and segment != ''
"""
_LISTED = """
    listed_hosts as (
        select host, {code} as code, 1672531200 + ({code} % 600) * 86400 as listed
        from (select distinct host from captures) as h
    ), listed_paths as (
        select host, segment, {code} as code from (select distinct host, segment from captures) as p
    )
"""


@query
def op9_temporal_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against a list of hosts, domains and sections that changes over two years."""
    from funnelspark.llm.url_filter import evaluate

    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = spark.sql(_CAPTURES.replace("from pages", "from {pages}"), pages=pages)
    code = "cast(conv(substring(md5(host), 1, 7), 16, 10) as bigint)"
    entries = spark.sql(f"with captures as (select * from {{captures}}), {_LISTED.format(code=code)} {_ENTRIES}", captures=captures)
    decided = evaluate(
        captures.selectExpr("page_id as capture_id", "url", "timestamp_seconds(fetched) as fetched_at"),
        entries.selectExpr("pattern", "action", "timestamp_seconds(listed) as listed_at"),
    )
    return decided.selectExpr(
        "capture_id as page_id", "verdict", "pattern", "unix_seconds(listed_from) as listed_from", "coalesce(verdict = 'block', false) as blocked"
    )


_CODE = "('0x' || substring(md5(host), 1, 7))::bigint"
ORACLES["op9_temporal_lists"] = f"""
with captures as ({_CAPTURES}), {_LISTED.format(code=_CODE)}, entries as ({_ENTRIES}),
per_second as (
    select pattern, listed, arg_min(action, case action when 'block' then 0 when 'allow' then 1 else 2 end) as verdict
    from entries group by pattern, listed
), intervals as (
    select pattern, verdict, listed as valid_from, lead(listed) over (partition by pattern order by listed) as valid_to from per_second
), keys as (
    select page_id, fetched, host || '/' || segment as key, 1 as depth, 9 as labels from captures where segment != ''
    union all
    select page_id, fetched, array_to_string(list_slice(parts, i, len(parts)), '.'), 0, len(parts) - i + 1
    from (select page_id, fetched, parts, unnest(range(1, len(parts) + 1)) as i
          from (select page_id, fetched, string_split(host, '.') as parts from captures) as a) as b
), best as (
    select page_id, verdict, pattern, valid_from, row_number() over (partition by page_id order by depth desc, labels desc) as place
    from keys join intervals
      on key = pattern and fetched >= valid_from and (valid_to is null or fetched < valid_to) and verdict != 'remove'
)
select c.page_id, b.verdict, b.pattern, b.valid_from::bigint as listed_from, coalesce(b.verdict = 'block', false) as blocked
from captures as c left join best as b on c.page_id = b.page_id and b.place = 1
"""


@query
def op8_k_means_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    from funnelspark.llm.nearest import neighbours

    vectors = table(spark, folder, "embeddings")
    return neighbours(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op7_adaptive_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate documents."""
    from funnelspark.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that match an earlier one."""
    from funnelspark.llm.line_dedup import drop_lines

    return drop_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op13_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens of two public tokenizers, aligned."""
    import public_tokenizers

    from funnelspark.llm.alignment import align_documents

    path = public_tokenizers.path
    return align_documents(table(spark, folder, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


@query
def op11_residue_gemm(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are every hundredth vector; every seventh label is moved on by one first."""
    from funnelspark.llm.hard_negatives import hard_negatives

    vectors = table(spark, folder, "embeddings")
    label = "if(vec_id % 7 = 0, (cast(label as bigint) + 1) % 10, cast(label as bigint)) as label"
    return hard_negatives(vectors.selectExpr("vec_id", "embedding", label), "id % 100 = 0")


ORACLES["op11_residue_gemm"] = """
with given as (
    select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), rows as (
    select row_number() over () as own, * from (select distinct * from given)
), met as (
    select a.own as anchor, a.vec_id as anchor_id, a.label as anchor_label, b.own, b.vec_id, b.label,
           coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
    from rows as a join rows as b on a.vec_id % 100 = 0 and a.own != b.own and len(a.v) = len(b.v)
), near as (
    select *, row_number() over (partition by anchor order by score desc, vec_id, own) as place from met where label = anchor_label
), far as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
           row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id, n.own) as rank
    from near as p join met as n
      on p.place <= 5 and n.anchor = p.anchor and n.label != p.anchor_label and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from far where rank <= 10
"""


@query
def op12_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings, compared within their labels."""
    from funnelspark.llm.cap_filters import near_vectors

    return near_vectors(table(spark, folder, "embeddings"), 0.93)
