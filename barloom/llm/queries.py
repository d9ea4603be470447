"""The registered queries of this subpackage and, where SQL can express them, their SQL.

Each query applies one operator to its whole table and derives the contract's columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import toxicity
from .chat import conversations, format_preferences, opening_pairs, worse_endings
from .common import LOWER, UPPER, materialize, table
from .exact_dedup import exact_dedup
from .hamming import hamming_top_k, sign_codes
from .line_dedup import dedup_lines
from .merkle import folded, manifest, proof_digest
from .mixing import mix
from .negatives import mine_negatives, quantized
from .pivots import embedding_components
from .sentencepiece_bpe import encode_decode
from .simhash import simhash_components
from .suffix_dedup import remove_repeats
from .wrapper import extract_articles


def default_model() -> str:
    """Where the public tokenizer's model lies; another path may be given to the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _sha(text):
    return F.sha2(text.cast("binary"), 256)


def encoded(docs):
    """The columns of op3 for a table of documents."""
    return encode_decode(docs, default_model()).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op3_sentencepiece(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))


def op1_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), _sha(F.col("kept")).alias("kept_sha256")
    )


def op2_wrapper(spark, sf_dir):
    found = extract_articles(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(toxicity.held_out(F.col("id")), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_mixing(spark, sf_dir):
    rows, plan = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), F.array("source"))
    rows = rows.select("doc_id", F.col("source").alias("of"), F.col("mix_size").alias("size"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))
    plan = plan.withColumnRenamed("size", "source_size")
    return rows.join(plan, F.col("of").eqNullSafe(F.col("source"))).select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_preferences(spark, sf_dir):
    convs = conversations(table(spark, sf_dir, "conversations")).withColumn("conv", F.col("conv") * 2)
    stale = worse_endings(convs).withColumn("conv", F.col("conv") + 1)
    both = materialize(convs.unionByName(stale))
    pairs = opening_pairs(both.where("conv % 2 = 0")).unionByName(
        both.where("conv % 2 != 0").select((F.col("conv") - 1).alias("chosen"), F.col("conv").alias("rejected"))
    )
    return format_preferences(both, pairs).select(
        F.expr("chosen div 2").alias("chosen"),
        F.expr("(rejected - pmod(rejected, 2)) div 2").alias("rejected"),
        (F.expr("pmod(rejected, 2)") == 1).alias("stale"),
        "n_prompt",
        "prompt",
        F.col("chosen_completion.text").alias("chosen_text"),
        F.to_json("chosen_completion.mask").alias("chosen_mask"),
        F.col("rejected_completion.text").alias("rejected_text"),
        F.to_json("rejected_completion.mask").alias("rejected_mask"),
    )


def op9_hamming(spark, sf_dir):
    codes = materialize(sign_codes(table(spark, sf_dir, "embeddings")))
    return hamming_top_k(codes, codes.where("id % 20 = 0"), 10).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "distance"
    )


def op10_simhash(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_pivots(spark, sf_dir):
    return embedding_components(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_merkle(spark, sf_dir):
    lower = F.translate("text", UPPER, LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": lower}, when=tampered)
    found = found.select("*", folded(F.col("changed_leaf"), F.col("path")).alias("folded_root"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_negatives(spark, sf_dir):
    rows = quantized(table(spark, sf_dir, "embeddings"), "case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    rows = materialize(rows)
    return mine_negatives(rows, rows.where("id % 100 = 0"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_wrapper": op2_wrapper,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_preferences": op8_preferences,
    "op9_hamming": op9_hamming,
    "op10_simhash": op10_simhash,
    "op11_pivots": op11_pivots,
    "op12_merkle": op12_merkle,
    "op13_negatives": op13_negatives,
}

ORACLE_SQL = {
    "op8_preferences": """
        WITH t AS (
            SELECT DISTINCT conv_id * 2 AS conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
        a AS (SELECT conv_id, max(k) AS last, arg_min(text, k) AS stale, arg_max(text, k) AS fresh FROM m WHERE role = 'assistant' GROUP BY conv_id),
        n AS (
            SELECT conv_id, k, role, text FROM m
            UNION ALL
            SELECT m.conv_id + 1, k, role, CASE WHEN k = last THEN stale ELSE text END FROM m JOIN a ON m.conv_id = a.conv_id AND stale <> fresh),
        p AS (
            SELECT a.conv_id AS rejected, min(b.conv_id) AS chosen
            FROM n a JOIN n b ON a.k = 1 AND b.k = 1 AND a.role = b.role AND a.text = b.text AND a.conv_id % 2 = 0 AND b.conv_id % 2 = 0
            GROUP BY a.conv_id
            UNION ALL
            SELECT DISTINCT conv_id, conv_id - 1 FROM n WHERE conv_id % 2 <> 0),
        e AS (
            SELECT chosen, rejected, coalesce(min(k) FILTER (WHERE NOT same), max(k) + 1) - 1 AS n_prompt
            FROM (SELECT p.chosen, p.rejected, r.k, c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AS same
                  FROM p JOIN n r ON r.conv_id = p.rejected LEFT JOIN n c ON c.conv_id = p.chosen AND c.k = r.k
                  WHERE p.chosen <> p.rejected)
            GROUP BY ALL),
        s AS (
            SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS x FROM n),
        w AS (
            SELECT e.*, s.conv_id, s.k, s.role, s.x,
                   coalesce(sum(length(x)) OVER (PARTITION BY e.chosen, e.rejected, s.conv_id ORDER BY s.k
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM e JOIN s ON s.conv_id IN (e.chosen, e.rejected) AND s.k > e.n_prompt),
        d AS (
            SELECT chosen, rejected, conv_id, string_agg(x, '' ORDER BY k) AS txt,
                   '[' || coalesce(string_agg('{"start":' || (before + length(role) + 13) || ',"end":' || (before + length(x) - 1) || '}', ',' ORDER BY k)
                                   FILTER (WHERE role = 'assistant'), '') || ']' AS mask
            FROM w GROUP BY ALL)
        SELECT e.chosen // 2 AS chosen, e.rejected // 2 AS rejected, e.rejected % 2 = 1 AS stale, e.n_prompt::INTEGER AS n_prompt,
               coalesce((SELECT string_agg(x, '' ORDER BY k) FROM s WHERE s.conv_id = e.chosen AND s.k <= e.n_prompt), '') AS prompt,
               coalesce(a.txt, '') AS chosen_text, coalesce(a.mask, '[]') AS chosen_mask,
               coalesce(b.txt, '') AS rejected_text, coalesce(b.mask, '[]') AS rejected_mask
        FROM e LEFT JOIN d a ON a.chosen = e.chosen AND a.rejected = e.rejected AND a.conv_id = e.chosen
               LEFT JOIN d b ON b.chosen = e.chosen AND b.rejected = e.rejected AND b.conv_id = e.rejected""",
    "op9_hamming": """
        WITH c AS (
            SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN 1 ELSE 0 END) AS bits
            FROM embeddings WHERE vec_id IS NOT NULL),
        d AS (
            SELECT q.id AS query_id, c.id AS vec_id, list_sum(list_transform(list_zip(q.bits, c.bits), lambda x: CASE WHEN x[1] <> x[2] THEN 1 ELSE 0 END)) AS distance
            FROM c q, c WHERE q.id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
        SELECT query_id, rank::INTEGER AS rank, vec_id, distance::INTEGER AS distance FROM r WHERE rank <= 10""",
    "op7_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)""",
    "op11_pivots": """
        WITH RECURSIVE t AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v, list_aggregate(list_transform(embedding, lambda x: x::DOUBLE * x), 'sum') ** 0.5 AS norm
            FROM embeddings),
        e AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM t a JOIN t b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE a.norm > 0 AND b.norm > 0 AND isfinite(a.norm) AND isfinite(b.norm) AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
        r AS (SELECT vec_id AS id, vec_id AS low FROM t UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.id),
        c AS (SELECT id, min(low) AS component_id FROM r GROUP BY id),
        n AS (SELECT a AS id, count(*) AS n_links FROM e GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM t JOIN c ON c.id = vec_id LEFT JOIN n ON n.id = vec_id""",
    "op12_merkle": """
        WITH RECURSIVE d AS (
            SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   list_transform(range(8 * strlen(doc_id::VARCHAR)),
                                  lambda i: CASE WHEN i % 8 = 0 THEN ord(substr(doc_id::VARCHAR, (i // 8 + 1)::BIGINT, 1)) ELSE 0 END::BIGINT) AS bits
            FROM documents),
        c AS (
            SELECT *, list_reduce(list_prepend(4294967295::BIGINT, bits),
                                  lambda h, x: xor(xor(h, x) >> 1, CASE WHEN xor(h, x) % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT)) AS crc
            FROM d),
        l AS (
            SELECT doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE leaf END AS changed,
                   dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM c),
        u AS (
            SELECT tree, 0 AS level, pos, n, leaf AS digest FROM l
            UNION ALL
            SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
            FROM u WHERE n > 1 GROUP BY tree, level, pos // 8, n),
        v AS (
            SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, digest FROM u WHERE n = 1
            UNION ALL
            SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
            FROM v WHERE n > 1 GROUP BY level, pos // 8, n),
        f AS (
            SELECT doc_id, leaf, tree, pos AS place, 0 AS level, pos, n, changed AS digest, '' AS proof FROM l
            UNION ALL
            SELECT f.doc_id, f.leaf, f.tree, f.place, f.level + 1, f.pos // 8, (f.n + 7) // 8,
                   sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.digest ELSE u.digest END, '' ORDER BY u.pos)),
                   f.proof || coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (WHERE u.pos <> f.pos), '')
            FROM f JOIN u ON u.tree = f.tree AND u.level = f.level AND u.pos // 8 = f.pos // 8
            WHERE f.n > 1 GROUP BY f.doc_id, f.leaf, f.tree, f.place, f.level, f.pos, f.n, f.digest, f.proof),
        g AS (
            SELECT f.doc_id, f.leaf, f.tree, f.place, u.digest AS subroot, 0 AS level, f.tree AS pos, v.n, f.digest, f.proof
            FROM f JOIN u ON u.tree = f.tree AND u.n = 1 JOIN v ON v.level = 0 AND v.pos = f.tree WHERE f.n = 1
            UNION ALL
            SELECT g.doc_id, g.leaf, g.tree, g.place, g.subroot, g.level + 1, g.pos // 8, (g.n + 7) // 8,
                   sha256(string_agg(CASE WHEN v.pos = g.pos THEN g.digest ELSE v.digest END, '' ORDER BY v.pos)),
                   g.proof || coalesce(string_agg(v.digest, '' ORDER BY v.pos) FILTER (WHERE v.pos <> g.pos), '')
            FROM g JOIN v ON v.level = g.level AND v.pos // 8 = g.pos // 8
            WHERE g.n > 1 GROUP BY g.doc_id, g.leaf, g.tree, g.place, g.subroot, g.level, g.pos, g.n, g.digest, g.proof)
        SELECT doc_id, leaf, subroot, v.digest AS root, sha256(proof) AS proof_sha256, g.digest AS folded_root, g.digest = v.digest AS verified
        FROM g JOIN v ON v.n = 1 WHERE g.n = 1""",
    "op13_negatives": """
        WITH t AS (
            SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM t a JOIN t b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.v) = len(b.v) AND len(a.v) > 0),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER w <= 10""",
}
