"""One query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import (
    balltree,
    boilerplate,
    curriculum,
    exactdup,
    hashtree,
    jaccard,
    language,
    lexical,
    merkle,
    packing,
    risk,
    secrets,
    surrogates,
)

#: The key under which surrogates are drawn in the checks. A real one is a secret.
CHECK_KEY = "rillflow-check"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_personal_data(documents(spark, sf_dir), CHECK_KEY)
    return replaced.select("doc_id", "text", "n_replaced")


def op3_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(documents(spark, sf_dir))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda total, take: total + take["words"])
    position = F.element_at("takes", 1)["position"]
    result = mixed.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        taken.alias("taken"),
        F.size("takes").alias("copies"),
        F.when(F.size("takes") > 0, position).alias("position"),
    )
    return result.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path()).drop("doc_row")


def op6_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", balltree.quantized().alias("v"))
    return balltree.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree, grown = hashtree.regular_tree(16), hashtree.regular_tree(17)
    return hashtree.shard_documents(documents(spark, sf_dir), tree, grown).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    samples = language.sample_texts(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return language.identify(docs, samples).select(
        "row.doc_id", language.held_out("row.doc_id").alias("held_out"), "found.lang_pred", "found.score"
    )


def op9_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(documents(spark, sf_dir))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_dropped")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.documents_manifest(documents(spark, sf_dir))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    leaf = F.when(tampered & F.col("changed").isNotNull(), F.col("changed")).otherwise(F.col("leaf"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        merkle.folded(leaf, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_surrogates,
        op3_curriculum,
        op4_ngram_jaccard,
        op5_packing,
        op6_ball_tree,
        op7_hash_tree,
        op8_cross_parsing,
        op9_extendible_hash,
        op10_site_lines,
        op11_merkle,
        op12_lexical,
        op13_quality_rules,
    )
}

ORACLES: dict[str, str] = {
    "op6_ball_tree": """
        with good as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), pairs as (
            select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
            from good q join good c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
            from pairs
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op9_extendible_hash": """
        with plain as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents
        ), groups as (
            select t, max(doc_id) as keep_id, count(*) as group_size from plain group by t
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
        from plain join groups using (t)
    """,
    "op10_site_lines": """
        with lines as (
            select doc_id, source, unnest(string_split(text, chr(10))) as line,
                   generate_subscripts(string_split(text, chr(10)), 1) as nr
            from documents
            where text is not null
        ), keyed as (
            select *, trim(line, ' ' || chr(9) || chr(13)) as k from lines
        ), pages as (
            select source, count(*) as n from documents where source is not null group by source
        ), bad as (
            select source, k
            from (select source, k, count(distinct doc_id) as w from keyed where k <> '' group by source, k)
            join pages using (source)
            where w >= 5 and w > 0.05::double * n
        ), kept as (
            select keyed.doc_id, nr, line, bad.k is not null as dropped
            from keyed left join bad on keyed.source = bad.source and keyed.k = bad.k
        ), joined as (
            select doc_id, string_agg(line, chr(10) order by nr) filter (where not dropped) as body,
                   count(*) as n_lines, count(*) filter (where dropped) as n_dropped
            from kept group by doc_id
        )
        select doc_id, case when text is null then null else coalesce(body, '') end as text,
               coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped
        from documents left join joined using (doc_id)
    """,
    "op11_merkle": """
        with recursive coded as (
            select doc_id, lang, n_chars,
                   coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
                   coalesce(strlen(text) || ':' || text, '-') as tail
            from documents
        ), crc_table as (
            select list_transform(range(256), lambda i: list_reduce(
                       list_prepend(i, range(8)),
                       lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
        ), leaves as (
            select doc_id, lang,
                   sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
                   sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) as changed,
                   xor(list_reduce(
                       list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)),
                       lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295) % 7 = 0 as tampered,
                   row_number() over (partition by lang order by doc_id) - 1 as pos,
                   count(*) over (partition by lang) as n
            from coded, crc_table
        ), langs as (
            select lang, row_number() over (order by lang nulls first) - 1 as tree, count(*) over () as trees
            from (select distinct lang from documents)
        ), nodes as (
            select tree, 0 as level, pos, leaf as h, n
            from leaves join langs on leaves.lang is not distinct from langs.lang
            union all
            select tree, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), any_value((n + 1) // 2)
            from nodes where n > 1 group by tree, level, pos // 2
        ), tops as (
            select 0 as level, tree as pos, h, trees as n from nodes join langs using (tree) where n = 1
            union all
            select level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), any_value((n + 1) // 2)
            from tops where n > 1 group by level, pos // 2
        ), path as (
            select leaves.doc_id, s.level, s.pos < (leaves.pos >> s.level) as before, other.h
            from leaves join langs on leaves.lang is not distinct from langs.lang
            join nodes s on s.tree = langs.tree and s.n > 1 and s.pos = leaves.pos >> s.level
            left join nodes other on other.tree = s.tree and other.level = s.level and other.pos = xor(s.pos, 1::bigint)
            union all
            select leaves.doc_id, 1000 + s.level, null, other.h
            from leaves join langs on leaves.lang is not distinct from langs.lang
            join tops s on s.n > 1 and s.pos = langs.tree >> s.level
            left join tops other on other.level = s.level and other.pos = xor(s.pos, 1::bigint)
        ), proofs as (
            select doc_id, list(coalesce(h, '') order by level) as hs, count(*) filter (where level < 1000) as below
            from path group by doc_id
        ), folds as (
            select leaves.doc_id, 1 as step, case when tampered then changed else leaf end as node, hs, below, pos, tree
            from leaves join langs on leaves.lang is not distinct from langs.lang left join proofs using (doc_id)
            union all
            select doc_id, step + 1,
                   case when (case when step <= below then pos >> (step - 1) else tree >> (step - 1 - below) end) & 1 = 1
                        then sha256(hs[step] || node) else sha256(node || hs[step]) end,
                   hs, below, pos, tree
            from folds where step <= len(hs)
        )
        select leaves.doc_id, leaf, sub.h as subroot, top.h as root,
               sha256(coalesce(array_to_string(proofs.hs, ''), '')) as proof_sha256,
               node as folded_root, node = top.h as verified
        from leaves join langs on leaves.lang is not distinct from langs.lang
        left join proofs using (doc_id)
        join folds on folds.doc_id = leaves.doc_id and folds.step = coalesce(len(proofs.hs), 0) + 1
        join nodes sub on sub.tree = langs.tree and sub.n = 1
        join tops top on top.n = 1
    """,
    "op12_lexical": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ), asked as (
            select item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ), counts as (
            select doc_id, term, count(*) as tf from words group by doc_id, term
        ), lengths as (
            select doc_id, cast(sum(tf) as bigint) as n from counts group by doc_id
        ), total as (
            select count(*) as docs, cast(sum(n) as bigint) as words from lengths
        ), weights as (
            select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) as bigint) as w
            from counts, total group by term, docs
        ), norms as (
            select doc_id, 25 + (75 * n * docs) // words as m from lengths, total
        ), scores as (
            select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
            from asked join weights using (term) join counts using (term) join norms using (doc_id)
            group by item_id, doc_id
        ), ranked as (
            select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
            from scores where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
}
