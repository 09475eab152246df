"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.llm import (
    decontaminate,
    embedding_dedup,
    packing,
    prefix_trie,
    quality,
    ranked_search,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    warc,
)
from lossmill.llm.common import stored, table
from lossmill.sinks.scratch import scratch_path

#: The rules that the query of the url filter applies.
URL_RULES = (
    url_filter.UrlRule("allow", "com", "/"),
    url_filter.UrlRule("block", "example.com", "/en/"),
    url_filter.UrlRule("allow", "www.example.com", "/en/"),
    url_filter.UrlRule("block", "net", "/es/"),
    url_filter.UrlRule("block", "net", "/fr/"),
)

TOXIC_SCORE = 0.3
#: Passages of over 50 words.
PASSAGE_WORDS = 51
KEPT_TAIL = 0.5


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path)


def held_out(doc_id: Column) -> Column:
    """The fold that no model is fitted on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxic_lexicon(docs: DataFrame, labels: DataFrame) -> toxicity.Lexicon:
    return toxicity.learn_lexicon(docs, labels.where(~held_out(F.col("doc_id"))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxic_lexicon(docs, table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return toxicity.with_toxicity(docs, lexicon).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= TOXIC_SCORE).cast("int").alias("predicted"),
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicate_components(docs, "doc_id", "text")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of 400 bytes, and beside them passages of over 50 words, whatever their bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    report = suffix_dedup.repeat_report(F.col("text"), F.col("repeats"))
    kept = suffix_dedup.kept_text(F.col("text"), F.col("repeats"))
    passages = suffix_dedup.passage_report(F.col("text"), F.col("passages"))
    return suffix_dedup.with_repeats(docs, words=PASSAGE_WORDS).select(
        "doc_id",
        *(c.alias(name) for name, c in report.items()),
        kept.alias("text"),
        *(c.alias(name) for name, c in passages.items()),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, path, public_tokenizers.PATTERN)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments are short here, so that many pages have several."""
    return warc.round_trip(table(spark, sf_dir, "pages"), segment_bytes=4096)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    report = decontaminate.contamination_report(F.col("benchmark_hits"))
    return found.select("doc_id", *(c.alias(name) for name, c in report.items()))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 for low quality, 1 for quality that is toxic, 2 for quality that is not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - F.col("toxic"))
    model = quality.fit_ordinal(docs, labels.select("doc_id", grade.alias("grade")))
    tails = F.col("quality.tails")
    at_least_1 = F.get(tails, F.lit(0))
    return quality.with_grade(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality.expected_grade").alias("expected_grade"),
        at_least_1.alias("p_grade_1_or_better"),
        F.get(tails, F.lit(1)).alias("p_grade_2_or_better"),
        F.coalesce(at_least_1 >= KEPT_TAIL, F.lit(False)).alias("kept"),
    )


DONOR_STEP = 20
HEAD_TURNS = 4


def rebuilt(turns: DataFrame) -> DataFrame:
    """Digested turns of conversations that share their first turns: a conversation c has the
    first h turns of c - c % 20, h being the remainder of its checksum by 4, then its own turns
    after the first h. A row without a digest makes each conversation known."""
    turns = stored(turns, "rebuilt-turns")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    heads = turns.where((F.col("conv_id") % DONOR_STEP == 0) & (F.col("position") < HEAD_TURNS))
    heads = heads.withColumnRenamed("conv_id", "donor")
    known = turns.where("position = 1").select("conv_id", taken.alias("taken"))
    known = known.withColumn("donor", F.col("conv_id") - F.col("conv_id") % DONOR_STEP)
    shared = known.join(heads, "donor").where("position <= taken")
    own = turns.where(F.col("position") > taken)
    marks = known.select(
        "conv_id",
        F.lit(0).cast("long").alias("position"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("words"),
    )
    return own.unionByName(shared.select(own.columns)).unionByName(marks)


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.digested(table(spark, sf_dir, "conversations"))
    trie = prefix_trie.prefix_trie(rebuilt(turns))
    return prefix_trie.with_ends_sha256(trie).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to new files in the shared folder, then read from them."""
    path = scratch_path(spark, "token-archive") + "/archive"
    docs = table(spark, sf_dir, "documents")
    token_files.write_archive(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType)
    return token_files.read_archive(spark, path).withColumn("doc_id", doc_id)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    found = ranked_search.search(index, table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_token_files": op12_token_files,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op1_url_filter": r"""
        WITH rest AS (
            SELECT page_id,
                CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                    ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
            FROM rest
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
                ('block', 'net', '/fr/')
        ), hits AS (
            SELECT host, path,
                max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                max_by(verdict, length(rule_host || rule_path)) AS verdict
            FROM (SELECT DISTINCT host, path FROM parts) p
            JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                AND starts_with(path, rule_path)
            GROUP BY host, path
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN hits USING (host, path)
    """,
    "op8_warc": """
        WITH sized AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                sha1(coalesce(html, '')) AS hex
            FROM pages
        ), digests AS (
            SELECT hex, list_aggregate(list_transform(range(32), lambda k: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (k // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31
                )::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest
            FROM (SELECT DISTINCT hex FROM sized)
        ), firsts AS (
            SELECT hex, min(page_id) AS first_id FROM sized GROUP BY hex
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM sized JOIN digests USING (hex) JOIN firsts USING (hex)
    """,
    "op9_benchmark_decontamination": r"""
        WITH item_words AS (
            SELECT item_id, row_number() OVER () AS item_row, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), item_windows AS (
            SELECT DISTINCT item_id, w[k:k + 9] AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k
                FROM item_words WHERE len(w) > 0)
        ), doc_words AS (
            SELECT doc_id, row_number() OVER () AS doc_row, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), lengths AS (SELECT DISTINCT len(win) AS n FROM item_windows),
        doc_windows AS (
            SELECT doc_row, n, k, w[k:k + n - 1] AS win
            FROM (SELECT doc_row, w, n, unnest(range(1, len(w) - n + 2)) AS k
                FROM doc_words, lengths WHERE len(w) >= n)
        ), hits AS (
            SELECT doc_row, n, k, item_id FROM doc_windows JOIN item_windows USING (win)
        ), hit_words AS (
            SELECT doc_row, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_row, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_row
        ), hit_items AS (
            SELECT doc_row, count(*) AS n_items,
                sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
            FROM (SELECT DISTINCT doc_row, item_id FROM hits) GROUP BY doc_row
        )
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
            coalesce(n_items, 0) AS n_items,
            coalesce(items_sha256, sha256('')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit_words USING (doc_row) LEFT JOIN hit_items USING (doc_row)
    """,
    "op11_conversation_prefix_trie": r"""
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT conv_id, conv_id - conv_id % 20 AS donor,
                xor(list_reduce(list_prepend(4294967295::BIGINT,
                    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i:
                        CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
                    4294967295) % 4 AS taken
            FROM (SELECT DISTINCT conv_id FROM own)
        ), turns AS (
            SELECT i.conv_id, pos, role, text FROM ids i JOIN own ON own.conv_id = donor
            WHERE pos <= taken
            UNION ALL
            SELECT i.conv_id, pos, role, text FROM ids i JOIN own USING (conv_id)
            WHERE pos > taken
        ), paths AS (
            SELECT conv_id, row_number() OVER w AS depth,
                list({'role': role, 'text': text}) OVER w AS path,
                len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
                count(*) OVER (PARTITION BY conv_id) AS n_turns
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
            UNION ALL
            SELECT conv_id, 0, [], 0, (SELECT count(*) FROM turns t WHERE t.conv_id = ids.conv_id)
            FROM ids
        ), nodes AS (
            SELECT min(conv_id) AS conv_id, depth, path, count(*) AS n_convs,
                min(words) AS words, sha256(coalesce(string_agg(conv_id::VARCHAR, ','
                    ORDER BY conv_id) FILTER (WHERE depth = n_turns), '')) AS ends_sha256
            FROM paths GROUP BY depth, path
        ), children AS (
            SELECT depth - 1 AS depth, path[:-2] AS path, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY ALL
        ), counted AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children
            FROM nodes n LEFT JOIN children USING (depth, path)
        ), sums AS (
            SELECT a.depth, a.path, sum((v.n_convs - 1) * v.words) AS saved_tokens,
                count(*) FILTER (WHERE v.n_children = 0) AS n_leaves
            FROM counted v JOIN paths a ON a.conv_id = v.conv_id AND a.depth <= v.depth
            GROUP BY a.depth, a.path
        )
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
            s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
        FROM counted c JOIN sums s USING (depth, path)
        LEFT JOIN counted p ON p.depth = c.depth - 1 AND p.path = c.path[:-2]
    """,
    "op13_ranked_search": r"""
        WITH item_terms AS (
            SELECT DISTINCT item_row, item_id, unnest(words) AS term
            FROM (SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM benchmark)
        ), docs AS (
            SELECT row_number() OVER () AS doc_row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), counts AS (
            SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms
            FROM docs WHERE len(words) > 0
        ), found AS (
            SELECT doc_row, doc_id, n, term, count(*) AS tf
            FROM (SELECT doc_row, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
            WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
        ), weights AS (
            SELECT term,
                floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM found, counts GROUP BY term, n_docs
        ), scores AS (
            SELECT item_row, item_id, doc_row, doc_id, sum(w * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM item_terms JOIN found USING (term) JOIN weights USING (term), counts
            GROUP BY item_row, item_id, doc_row, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_row
                ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
