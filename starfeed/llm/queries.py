"""The operators on the given tables: thin queries with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfeed.llm.bpe_automaton import encoded
from starfeed.llm.conversation_repair import damaged, digests, repaired
from starfeed.llm.embedding_dedup import near_duplicates
from starfeed.llm.hamming_search import sign_code, top_k
from starfeed.llm.jaccard_join import jaccard_classes
from starfeed.llm.packing import pack
from starfeed.llm.periodic_runs import periodic_runs, with_planted_runs
from starfeed.llm.perplexity import judged
from starfeed.llm.pii import KINDS, count_of, listed, personal_data
from starfeed.llm.pitman_yor import scored
from starfeed.llm.secrets import findings
from starfeed.llm.text import table
from starfeed.llm.url_filter import judged as judged_urls
from starfeed.llm.warc import archive_round_trip


def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).drop("payload", "url")


def op2_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))


def op5_kneser_ney_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("_row.doc_id", *[c for c in rows.columns if c not in ("_row", "lang")])


def op6_url_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages"))


def op7_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest codes of each vector whose id is divisible by 20, one row for each neighbour."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code("embedding").alias("code"))
    near = top_k(rows, rows.where("id % 20 = 0"))
    return near.select(F.col("id").alias("vec_id"), F.posexplode("neighbours").alias("place", "near")).select(
        "vec_id", (F.col("place") + 1).alias("rank"), F.col("near.id").alias("neighbour_id"), F.col("near.distance").alias("distance")
    )


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_links", "n_copies")


def op9_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS]
    rows = personal_data(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), with_ids=False)


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with repetitions planted in a tenth of them: their runs, and the one with the most periods."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = periodic_runs(docs, keep=[F.col("doc_id")])
    longest = F.expr(
        "aggregate(runs, cast(null as struct<start: long, length: long, period: long>),"
        " (best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return rows.withColumn("longest", longest).select(
        "_row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_lattice_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired; one that lost all its rows has nothing to repair."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = repaired(damaged(turns))
    result = repair.conversations.join(digests(repair.rows).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    all_ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    rows = all_ids.join(result, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return rows.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))


QUERIES = {
    "op1_warc_capture_index": op1_warc_capture_index,
    "op2_concat_and_cut": op2_concat_and_cut,
    "op3_secret_forest": op3_secret_forest,
    "op4_pitman_yor": op4_pitman_yor,
    "op5_kneser_ney_bands": op5_kneser_ney_bands,
    "op6_url_likelihood_ratio": op6_url_likelihood_ratio,
    "op7_multi_index_hashing": op7_multi_index_hashing,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_bootstrapped_pii": op9_bootstrapped_pii,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_recompression_runs": op11_recompression_runs,
    "op12_cross_polytope": op12_cross_polytope,
    "op13_lattice_repair": op13_lattice_repair,
}

#: DuckDB statements, for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op1_warc_capture_index": """
        with p as (
            select page_id, coalesce(html, '') as payload from pages
        ), d as (
            select page_id, octet_length(encode(payload))::bigint as payload_bytes, sha1(payload) as payload_digest from p
        ), h as (
            select payload_digest, max(page_id) as holder from d where payload_bytes >= 1000 group by payload_digest
        )
        select page_id, payload_bytes, payload_digest,
            case when holder > page_id then 'revisit' else 'response' end as record_type,
            case when holder > page_id then holder end as refers_to
        from d left join h using (payload_digest)
    """,
    "op7_multi_index_hashing": """
        with c as (
            select vec_id, list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end) as bits from embeddings
        ), code as (
            select vec_id, array_to_string(bits, '')::bit as code from c
        ), pairs as (
            select q.vec_id, r.vec_id as neighbour_id, bit_count(xor(q.code, r.code))::int as distance
            from code q join code r on q.vec_id % 20 = 0 and q.vec_id <> r.vec_id
        ), ranked as (
            select *, row_number() over (partition by vec_id order by distance, neighbour_id)::int as rank from pairs
        )
        select vec_id, rank, neighbour_id, distance from ranked where rank <= 10
    """,
    "op8_ngram_jaccard": r"""
        with recursive w as (
            select doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
            from documents
        ), s as (
            select doc_id, unnest(list_distinct(
                case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                     when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end)) as gram
            from w
        ), sizes as (
            select doc_id, count(*) as n from s group by doc_id
        ), common as (
            select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (gram) where a.doc_id <> b.doc_id group by x, y
        ), links as (
            select x, y from common join sizes nx on nx.doc_id = x join sizes ny on ny.doc_id = y where c >= 0.8 * (nx.n + ny.n - c)
        ), reach as (
            select doc_id as x, doc_id as y from documents
            union
            select r.x, l.y from reach r join links l on r.y = l.x
        ), classes as (
            select x as doc_id, min(y) as class_id from reach group by x
        ), different as (
            select x as doc_id, count(*) as n_links from links
            join documents a on a.doc_id = x join documents b on b.doc_id = y where a.text <> b.text group by x
        )
        select doc_id, class_id, coalesce(n_links, 0)::bigint as n_links,
            case when len(ws) > 0 then count(*) over (partition by w.text) else 1 end as n_copies
        from w join classes using (doc_id) left join different using (doc_id)
    """,
    "op12_cross_polytope": """
        with recursive v as (
            select row_number() over () as i, vec_id, cast(embedding as double[]) as e, list_sum(list_transform(e, lambda x: x * x)) as n from embeddings
        ), good as (
            select * from v where n > 0 and isfinite(n) and len(list_filter(e, lambda x: x is null)) = 0
        ), links as (
            select a.i as x, b.i as y from good a join good b on a.i <> b.i and len(a.e) = len(b.e)
            where list_dot_product(a.e, b.e) >= 0.9 * sqrt(a.n) * sqrt(b.n)
        ), reach as (
            select i as x, i as y from v
            union
            select r.x, l.y from reach r join links l on r.y = l.x
        ), named as (
            select x as i, min(vec_id) as component_id from reach join v on v.i = y group by x
        ), degree as (
            select x as i, count(*) as n_links from links group by x
        )
        select vec_id, coalesce(n_links, 0) as n_links, component_id, coalesce(vec_id = component_id, false) as kept
        from v join named using (i) left join degree using (i)
    """,
}
