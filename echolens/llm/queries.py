"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens.llm import (
    conversation_trie, embeddings, exact_dedup, hard_negatives, merge_dropout, minhash, packing, pii, quality,
    secrets, token_counts, top_search, toxicity,
)
from echolens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": lambda s, d: secrets.secret_scan(table(s, d, "documents")),
    "op2_vector_duplicates": lambda s, d: embeddings.near_duplicate_vectors(table(s, d, "embeddings")),
    "op3_packing": lambda s, d: packing.packed(table(s, d, "documents")),
    "op4_exact_dedup": lambda s, d: exact_dedup.exact_duplicates(table(s, d, "documents")),
    "op5_quality": lambda s, d: quality.quality(table(s, d, "documents"), table(s, d, "labels")),
    "op6_minhash": lambda s, d: minhash.near_duplicates(table(s, d, "documents")),
    "op7_token_counts": lambda s, d: token_counts.token_counts(table(s, d, "documents")),
    "op8_merge_dropout": lambda s, d: merge_dropout.dropout_round_trip(table(s, d, "documents")),
    "op9_personal_data": lambda s, d: pii.personal_data(table(s, d, "documents")),
    "op10_toxicity": lambda s, d: toxicity.toxicity(table(s, d, "documents"), table(s, d, "labels")),
    "op11_conversation_trie": lambda s, d: conversation_trie.prefix_trie(table(s, d, "conversations")),
    "op12_top_search": lambda s, d: top_search.top_search(table(s, d, "embeddings"), F.col("vec_id") % 50 == 0),
    "op13_hard_negatives": lambda s, d: hard_negatives.hard_negatives(
        # every seventh row counts as of the next label
        table(s, d, "embeddings").withColumn(
            "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        ),
        F.col("vec_id") % 100 == 0,
    ),
}

# Rows that take part in op12 and op13, as whole numbers.
_WHOLE = """
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

ORACLES: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), groups AS (
            SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM digests JOIN groups USING (text_sha256)
    """,
    "op6_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(
                string_split_regex(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'
                ), lambda x: x != ''
            ) AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
            FROM words, range(1, greatest(len(w) - 3, 2)) AS r(i) WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), sets AS (
            SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS print FROM shingles GROUP BY doc_id
        ), classes AS (
            SELECT print, min(doc_id) AS rep FROM sets GROUP BY print
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN classes ca ON ca.rep = a.doc_id JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
            JOIN classes cb ON cb.rep = b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
        ), edges AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach AS (
            SELECT rep AS node, rep AS low FROM classes
            UNION
            SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node
        ), lowest AS (
            SELECT node, min(low) AS low FROM reach GROUP BY node
        )
        SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(l.low, d.doc_id) AS component_id,
               d.doc_id = coalesce(l.low, d.doc_id) AS kept
        FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN sets USING (doc_id)
        LEFT JOIN classes USING (print) LEFT JOIN lowest l ON l.node = classes.rep
    """,
    "op2_vector_duplicates": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x != 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.vec_id != b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS node, vec_id AS low FROM v
            UNION
            SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node
        ), lowest AS (
            SELECT node, min(low) AS low FROM reach GROUP BY node
        ), counts AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        )
        SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(l.low, e.vec_id) AS component_id,
               e.vec_id = coalesce(l.low, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN counts c USING (vec_id) LEFT JOIN lowest l ON l.node = e.vec_id
    """,
    "op11_conversation_trie": r"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
                   len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '')) AS w
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list(struct_pack(t := t, w := w) ORDER BY turn NULLS FIRST, t) AS s FROM turns GROUP BY conv_id
        ), crc AS (
            SELECT conv_id, s, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
            )) % 4 AS h FROM own
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:c.h], c.s[c.h + 1:]) AS s
            FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
        ), prefixes AS (
            SELECT conv_id, d AS depth, d = len(s) AS ends, CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w,
                   list_aggregate(list_transform(s[1:d], lambda x: x.t), 'string_agg', ',') AS k,
                   list_aggregate(list_transform(s[1:d - 1], lambda x: x.t), 'string_agg', ',') AS up
            FROM rebuilt, range(0, len(s) + 1) AS r(d)
        ), nodes AS (
            SELECT depth, coalesce(k, '') AS k, CASE WHEN depth > 0 THEN coalesce(up, '') END AS up, min(conv_id) AS conv_id,
                   count(*) AS n_convs, any_value(w) AS w,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM prefixes GROUP BY ALL
        ), kids AS (
            SELECT up AS k, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up
        ), below AS (
            SELECT k AS top, k FROM nodes
            UNION ALL
            SELECT b.top, n.k FROM below b JOIN nodes n ON n.up = b.k
        ), sums AS (
            SELECT b.top AS k, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.w)::BIGINT AS saved_tokens
            FROM below b JOIN nodes n ON n.k = b.k LEFT JOIN kids ON kids.k = n.k GROUP BY b.top
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
               n_leaves, saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes p ON p.k = n.up
    """,
    "op12_top_search": f"""
        WITH whole AS ({_WHOLE}), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id != c.vec_id AND len(q.e) = len(c.e)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op13_hard_negatives": f"""
        WITH whole AS ({_WHOLE}), marked AS (
            SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM whole WHERE label IS NOT NULL
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM marked a JOIN marked c ON a.vec_id % 100 = 0 AND a.vec_id != c.vec_id AND len(a.e) = len(c.e)
        ), positives AS (
            SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
            FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
}
