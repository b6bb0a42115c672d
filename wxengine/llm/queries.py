"""Queries over the given tables, one for each operator, and SQL for the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wxengine.llm import (
    bpe,
    chat_format,
    decontaminate,
    embedding_dedup,
    html_extract,
    language_id,
    lm_scoring,
    ngram_join,
    prefix_pieces,
    secret_scan,
    spelling_variants,
    token_alignment,
    toxicity,
)

TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """crc32 of the document's id, as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *(count(kind) for kind in secret_scan.BASE_KINDS),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.score_texts(_table(spark, sf_dir, "documents"), remainder(7) != 2)
    return found.select(
        "doc_id",
        F.coalesce(remainder(7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(docs, remainder(4) != 2)
    return found.select(
        "doc_id",
        F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
        "_language.lang_pred",
        "_language.score",
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema
    )
    turns = chat_format.number_turns(given.unionByName(extra))
    return chat_format.read_back(*chat_format.pack(turns))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    found = toxicity.with_toxicity(docs, labels, remainder(5) != 0)
    return found.select(
        "doc_id",
        F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_embeddings(_table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.read_codec(public_tokenizers.path(TOKENIZER))
    found = bpe.encode_decode(_table(spark, sf_dir, "documents"), codec)
    return found.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(_table(spark, sf_dir, "documents"))


def op12_prefix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = prefix_pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    found = prefix_pieces.encode_decode(_table(spark, sf_dir, "documents"), model)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = token_alignment.align_documents(
        _table(spark, sf_dir, "documents"),
        bpe.read_codec(public_tokenizers.path(TOKENIZER)).content,
        prefix_pieces.read_model(public_tokenizers.path(PIECE_MODEL)),
    )
    return docs


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_language_id": op5_language_id,
    "op6_chat_format": op6_chat_format,
    "op7_html_extract": op7_html_extract,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_pieces": op12_prefix_pieces,
    "op13_token_alignment": op13_token_alignment,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP4_SQL = f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (
        SELECT item, w, least(13, len(w)) AS n,
            unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM item WHERE len(w) > 0
    )
), size AS (SELECT DISTINCT n FROM win
), place AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, size WHERE len(w) >= n
    )
), hit AS (
    SELECT doc_id, item, n, i FROM place JOIN win USING (n, s)
), word AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP10_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, component_id,
    vec_id = component_id AS kept
FROM embeddings JOIN component USING (vec_id)
"""

_OP3_SQL = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + least(3, len(w)) - 1], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i
        FROM doc WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), often AS (SELECT s, count(*) AS f FROM shingle GROUP BY s
), ranked AS (
    SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r
    FROM shingle JOIN often USING (s) JOIN size USING (doc_id)
), prefix AS (SELECT doc_id, s, n FROM ranked WHERE r <= n - ceil(0.9 * n) + 1
), candidate AS (
    SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m
    FROM prefix a JOIN prefix b USING (s)
    WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
), common AS (
    SELECT c.a, c.b, c.n, c.m, count(*) AS o
    FROM candidate c JOIN shingle x ON x.doc_id = c.a JOIN shingle y ON y.doc_id = c.b AND y.s = x.s
    GROUP BY ALL
), link AS (
    SELECT a, b FROM common WHERE 100 * o >= 90 * (n + m - o)
    UNION ALL SELECT b, a FROM common WHERE 100 * o >= 90 * (n + m - o)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN size USING (doc_id) JOIN component USING (doc_id)
"""

_OP6_SQL = """
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), learned AS (
    SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
        replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS body
    FROM given
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
    sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(length('<|im_start|>' || role || chr(10) || body || '<|im_end|>' || chr(10))) AS BIGINT)
        AS formatted_chars
FROM learned GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op6_chat_format": _OP6_SQL,
    "op3_ngram_join": _OP3_SQL,
    "op10_embedding_dedup": _OP10_SQL,
    "op4_decontaminate": _OP4_SQL,
}
