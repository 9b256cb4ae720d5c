"""One registered query for each operator; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm import (
    decontamination,
    extraction,
    hard_negatives,
    jaccard_join,
    language,
    ngram_lm,
    packing,
    preferences,
    quality_rules,
    site_quality,
    spelling,
    token_files,
    toxicity,
)
from packetflow.llm.common import id_remainder, table
from packetflow.session import work_dir


def tokenizer_path() -> str:
    """The vocabulary file that the packing queries use; installed beside Spark on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    model = language.train(docs.filter(~held_out))
    return language.predict(docs, model, (F.col("doc_id"), held_out.alias("held_out")))


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 0
    detector = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return toxicity.score_documents(docs, detector, (F.col("doc_id"), held_out.alias("held_out")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.score_documents(docs, field)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 7) == 2
    model = ngram_lm.train(docs.filter(~held_out))
    return ngram_lm.score_documents(docs, model, keep=(F.col("doc_id"), held_out.alias("held_out")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_join.linked_documents(docs, count_links=False)
    return found.select("doc_id", "n_shingles", "component_id")


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_pieces(table(spark, sf_dir, "conversations"))


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    model = site_quality.train(docs, table(spark, sf_dir, "labels"))
    return site_quality.score_documents(docs, model)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs, edits=spelling.EDIT_MODULUS))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = work_dir(spark, "token-files")
    token_files.write_tokens(docs, folder, tokenizer_path(), end=2)
    return token_files.read_digests(spark, folder)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", moved)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_extraction": op4_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_model": op7_language_model,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_preferences": op9_preferences,
    "op10_site_quality": op10_site_quality,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op8_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i
                  FROM words WHERE len(ws) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
            FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT x, y FROM shared
            JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * o >= 80 * (a.n + b.n - o)
        ),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other
        )
        SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
        FROM words w LEFT JOIN sizes s USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r
            USING (doc_id)
    """,
    "op9_preferences": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
            QUALIFY row_number() OVER (
                PARTITION BY conv_id, turn ORDER BY coalesce(role, ''), coalesce(text, '')) = 1
        ),
        replied AS (
            SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS place, count(*) OVER () AS total
            FROM (SELECT DISTINCT conv_id FROM turns WHERE role = 'assistant')
        ),
        partners AS (
            SELECT a.conv_id AS pair_id, b.conv_id AS other_id
            FROM replied a JOIN replied b ON b.place = a.place % a.total + 1 WHERE a.total > 1
        ),
        chosen AS (
            SELECT pair_id, other_id, turn, role, text
            FROM partners JOIN turns ON conv_id = pair_id
        ),
        rejected AS (
            SELECT pair_id, other_id, turn, role, text
            FROM partners JOIN turns ON conv_id = other_id
        ),
        ends AS (
            SELECT pair_id, min(CASE WHEN c.role IS DISTINCT FROM r.role
                OR c.text IS DISTINCT FROM r.text THEN turn END) AS prompt_end
            FROM chosen c FULL JOIN rejected r USING (pair_id, turn) GROUP BY pair_id
        ),
        parts AS (
            SELECT chosen.*, CASE WHEN turn >= prompt_end THEN 'chosen' ELSE 'prompt' END AS part,
                prompt_end FROM chosen JOIN ends USING (pair_id)
            UNION ALL
            SELECT rejected.*, 'rejected', prompt_end FROM rejected JOIN ends USING (pair_id)
            WHERE turn >= prompt_end
        ),
        rendered AS (
            SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
                AS rendered, part <> 'prompt' AND role = 'assistant' AS trained FROM parts
        ),
        placed AS (
            SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY turn
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM rendered
        )
        SELECT pair_id, other_id, part, turn, role, rendered, start,
            CASE WHEN trained THEN start + 13 + length(role) END AS trained_start,
            CASE WHEN trained THEN start + length(rendered) END AS trained_end, prompt_end
        FROM placed
    """,
    "op11_spelling_variants": r"""
        WITH RECURSIVE bytes AS (
            SELECT list(crc ORDER BY i) AS crcs
            FROM (SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1
                    THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS crc FROM range(256) t(i))
        ),
        found AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ),
        pairs AS (
            SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS spelled
            FROM found GROUP BY doc_id, run
        ),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                flatten(list_transform(string_split(spelled, ''), lambda c: CASE
                    WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                    ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)),
                lambda a, b: xor(a // 256, crcs[(xor(a, b) % 256) + 1]), 4294967295)) AS h
            FROM pairs, bytes
        ),
        words AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT CASE WHEN h % 97 = 0
                    THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
                FROM hashed)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ),
        cut AS (
            SELECT word, n, length(word) AS size, i, word[:i - 1] || word[i + 1:] AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b
                ON a.i = b.i AND a.size = b.size AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
        ),
        best AS (
            SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS other_n
            FROM near
            QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1
        ),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                CASE WHEN other_n >= 2 * w.n THEN other END AS form,
                CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ),
        paths AS (
            SELECT word, word AS reached FROM words
            UNION ALL
            SELECT paths.word, form FROM paths JOIN forms ON forms.word = paths.reached
            WHERE form IS NOT NULL
        )
        SELECT f.word, f.form, p.reached AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN paths p USING (word) JOIN forms e ON e.word = p.reached
        WHERE e.form IS NULL
    """,
    "op13_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                list_inner_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ),
        positives AS (
            SELECT * FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
            row_number() OVER (
                PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
            AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
}
