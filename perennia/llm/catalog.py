"""The registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm import bpe, caps, conversations, knn, language, lexical, licenses, minhash, packing, quality, toxicity
from perennia.llm import vafile, warc
from perennia.llm.common import prepare
from perennia.sources.scratch import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.vocabulary(spark, VOCABULARY)
    pieces = packing.cut_tokens(table(spark, sf_dir, "documents"), vocabulary)
    return packing.pack(pieces)


@query("op10_bpe")
def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.vocabulary(spark, VOCABULARY)
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    decoded = bpe.decode(encoded.drop("text"), vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def remainder(id: str, by: int):
    """crc32 of the id's text modulo ``by``: tells the rows that may be learned from."""
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(by))


@query("op1_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    scored = quality.score_documents(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op9_language_id")
def language_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared language and the source stand for markup and host; the text model is learned from both."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn_text(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    docs = docs.withColumn("letters", language.has_letters(F.col("text")))
    rows = language.evidence(docs, model, F.col("text"), F.col("lang"), F.col("source"), "doc_id", "letters")
    model = language.learn_evidence(rows, model)
    found = language.fuse(rows, model, "likelihoods", F.col("declared"), F.col("host"))
    kept = language.is_kept(F.col("letters"), F.col("confidence"))
    return found.select("doc_id", "language", "confidence", "declared", kept.alias("kept"))


@query("language_id_of_pages")
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: visible text, the lang attribute, and host and suffix of the address."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.learn_text(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    declared, host = language.declared_in_markup(F.col("html")), language.host_of(F.col("url"))
    rows = language.evidence(pages, model, language.text_of_markup(F.col("html")), declared, host, "page_id")
    model = language.learn_evidence(rows, model)
    found = language.fuse(rows, model, "likelihoods", F.col("declared"), F.col("host"))
    return found.select("page_id", "host", "declared", "language", "confidence")


@query(
    "op2_minhash_dedup",
    r"""
    with recursive words as (
        select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+') if x <> ''] as w
        from documents
    ),
    shingles as (
        select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
            else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end) as shingle
        from words
    ),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as c
        from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
    ),
    links as (
        select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * c >= 80 * (x.n + y.n - c)
    ),
    edges as (select a, b from links union all select b, a from links),
    reach(a, b) as (select a, b from edges union select r.a, l.b from reach r join edges l on r.b = l.a),
    roots as (select a, least(a, min(b)) as root from reach group by a)
    select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(root, doc_id) as component_id,
        coalesce(root, doc_id) = doc_id as kept
    from documents left join sizes using (doc_id) left join roots on roots.a = doc_id
    """,
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


USABLE_VECTOR = """embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0"""


@query(
    "op4_nearest_neighbours",
    f"""
    with v as (select vec_id, embedding::double[] as e from embeddings where vec_id is not null and {USABLE_VECTOR}),
    pairs as (
        select q.vec_id as query_id, c.vec_id,
            sqrt(list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(q.e, c.e)])) as score
        from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0
    )
    select query_id, cast(row_number() over (partition by query_id order by score, vec_id) as integer) as rank, vec_id, score
    from pairs qualify rank <= 10
    """,
)
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query(
    "op5_cap_dedup",
    f"""
    with recursive v as (
        select vec_id, label, embedding::double[] as e from embeddings
        where vec_id is not null and label is not null and {USABLE_VECTOR}
    ),
    links as (
        select a.vec_id as a, b.vec_id as b from v a join v b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
        where list_cosine_similarity(a.e, b.e) >= 0.98
    ),
    reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
    roots as (select a, least(a, min(b)) as root from reach group by a),
    counts as (select a, count(*) as n from links group by a)
    select e.vec_id, coalesce(n, 0)::bigint as n_links, coalesce(root, e.vec_id) as component_id,
        coalesce(root, e.vec_id) = e.vec_id as kept
    from embeddings e left join roots on roots.a = e.vec_id left join counts on counts.a = e.vec_id
    """,
)
def near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


@query(
    "op7_warc",
    """
    with p as (
        select page_id, encode(coalesce(html, '')) as body, sha1(coalesce(html, '')) as h from pages
    ),
    kept as (select h, max(page_id) as largest from p group by h)
    select page_id, octet_length(body)::bigint as payload_bytes,
        array_to_string([
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((cast('0x' || substr(p.h, 5 * (i // 4) + 1, 5) as integer)
                >> (15 - 5 * (i % 4))) & 31) + 1, 1)
            for i in range(32)], '') as payload_digest,
        case when page_id = largest then 'response' else 'revisit' end as record_type,
        case when page_id <> largest then largest end as refers_to
    from p join kept using (h)
    """,
)
def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.with_revisits(table(spark, sf_dir, "pages"))
    packages = warc.write(rows, scratch_path(spark, "warc"))
    records = warc.read(warc.located(packages), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.find(docs, licenses.learn(docs))


#: crc32 of ``key`` (ASCII), byte by byte and bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)))"""


def _rows_cost(state: int) -> str:
    """The cheapest way on from a state when the next row is edited, not preceded by an insert: (cost, audit, lines)."""
    put = conversations.NEXT[state]
    line, role = "chr(10) || r.role || ':' || r.text", conversations.ROLE_OF[put]
    rerole = f"chr(10) || '{role}:' || r.text"
    kept = {0: "when r.initial = 's' then 1 when r.initial = 'u' then 2", 1: "when r.initial = 'u' then 2", 2: "when r.initial = 'a' then 3", 3: "when r.initial = 'u' then 2"}[state]

    def way(letter: str, cost: str, to: str, line: str) -> str:
        return f"{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a, 't': {line} || {to}.t}}"

    target = f"(case {kept} end)"
    keeps = " ".join(f"when {target} = {t} then {way('K', 'r.late', f'd.v{t}', line)}" for t in (1, 2, 3))
    return f"""list_min([{way('D', '4', f'd.v{state}', "''")}, case when r.gone then null {keeps} end,
        case when not r.gone then {way('R', 'r.late + 3', f'd.v{put}', rerole)} end])"""


def _inserted(to: str, role: str) -> str:
    return f"{{'c': {to}.c + 3, 'a': 'I' || {to}.a, 't': chr(10) || '{role}:' || {to}.t}}"


@query(
    "op11_conversation_repair",
    f"""
    with recursive keyed as (
        select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations
    ),
    faulty as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {CRC32} % 20 as f from keyed
    ),
    damaged as (
        select conv_id, turn, case when f = 4 then 'user' else role end as role,
            case f when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
            unnest(range(case f when 0 then 0 when 3 then 2 else 1 end)) as copy
        from faulty
    ),
    ordered as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
            left(role, 1) as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as tail
        from damaged
    ),
    marked as (
        select *, case when tail = '' then 'blank'
                when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                when right(tail, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
            lag(initial) over (partition by conv_id order by i) as before
        from ordered
    ),
    counts as (
        select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
            count(*) filter (fault = 'truncated') as truncated,
            count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
        from marked group by conv_id
    ),
    todo as (select *, fault in ('blank', 'duplicate') as gone, case fault when 'truncated' then 3 else 0 end as late from marked),
    dp(conv_id, i, v0, v1, v2, v3) as (
        select conv_id, n + 1, {{'c': 0::bigint, 'a': '', 't': ''}}, {{'c': 6::bigint, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}},
            {{'c': 3::bigint, 'a': 'I', 't': chr(10) || 'assistant:'}}, {{'c': 0::bigint, 'a': '', 't': ''}}
        from counts
        union all
        select conv_id, i, least(w0, {_inserted('least(w2, ' + _inserted('w3', 'assistant') + ')', 'user')}),
            least(w1, {_inserted('least(w2, ' + _inserted('w3', 'assistant') + ')', 'user')}),
            least(w2, {_inserted('w3', 'assistant')}), least(w3, {_inserted('w2', 'user')})
        from (
            select d.conv_id, r.i, {', '.join(f'{_rows_cost(s)} as w{s}' for s in range(4))}
            from dp d join todo r on r.conv_id is not distinct from d.conv_id and r.i = d.i - 1
        )
    ),
    best as (select conv_id, v0 from dp where i = 1)
    select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
        coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
        coalesce(illegal, 0)::bigint as illegal, coalesce(v0.c, 0)::bigint as cost, coalesce(v0.a, '') as audit,
        sha256(coalesce(substr(v0.t, 2), '')) as repaired_sha256
    from (select distinct conv_id from conversations) o
    left join counts c on c.conv_id is not distinct from o.conv_id
    left join best b on b.conv_id is not distinct from o.conv_id
    """,
)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, copies)


@query(
    "op12_exact_top_k",
    """
    with v as (
        select vec_id, [floor(64 * x::double)::bigint for x in embedding] as e from embeddings
        where vec_id is not null and embedding is not null
            and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    ),
    pairs as (
        select q.vec_id as query_id, c.vec_id, coalesce(list_sum([x[1] * x[2] for x in list_zip(q.e, c.e)]), 0)::bigint as score
        from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0
    )
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from pairs qualify rank <= 20
    """,
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query(
    "op13_lexical_search",
    r"""
    with docs as (
        select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents
    ),
    items as (
        select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark
    ),
    sizes as (select count(*)::bigint as n_docs, sum(len(terms))::bigint as n_terms from docs where len(terms) > 0),
    tf as (
        select r, doc_id, len(terms)::bigint as n, term, count(*)::bigint as tf
        from (select r, doc_id, terms, unnest(terms) as term from docs) where term in (select term from items) group by all
    ),
    weights as (
        select term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)::double))::bigint as w from tf, sizes group by term
    ),
    scores as (
        select item_id, r, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint as score
        from items join tf using (term) join weights using (term), sizes group by item_id, r, doc_id
    )
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
    from scores where score > 0 qualify rank <= 50
    """,
)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
