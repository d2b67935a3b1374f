"""One query per operator, over the whole of its table, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import (
    bpe_stream,
    chat_format,
    decontamination,
    html_text,
    jaccard_join,
    language_id,
    lexical_search,
    merkle,
    packing,
    quality_rules,
    token_files,
    toxicity,
    url_templates,
)
from gaugeflow.llm.tables import held_out, load, tuned


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{session.work_folder(spark, 'token-files')}/shards"
    token_files.write_shards(load(spark, sf_dir, "documents"), path, tokenizer("byte_bpe_50k.json"))
    return token_files.document_digests(token_files.read_shards(spark, path))


#: The conversation that the contract adds: its texts are control strings of another template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    messages = rows.unionByName(added).withColumn("parts", chat_format.text_parts(F.col("text")))
    return chat_format.digests(session.stage(chat_format.format_conversations(messages), "chat"))


#: A document with this score or more is toxic.
TOXIC_SCORE = 0.3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").where(~held_out())
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_SCORE).cast("int"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").where(~held_out())
    return quality_rules.judge(docs, quality_rules.fit(docs, labels))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(load(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    named = docs.select("doc_id", held_out().alias("held_out"), language_id.identify("text", model).alias("named"))
    return named.select("doc_id", "held_out", "named.lang_pred", "named.score")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.jaccard_join(load(spark, sf_dir, "documents"), size=3, num=90, den=100)
    return joined.select("doc_id", "n_shingles", "component_id")


#: (host, path) of the contract, in its order.
URL_RULES = [
    url_templates.Rule("com", "/", "allow"),
    url_templates.Rule("example.com", "/en/", "block"),
    url_templates.Rule("www.example.com", "/en/", "allow"),
    url_templates.Rule("net", "/es/", "block"),
    url_templates.Rule("net", "/fr/", "block"),
]


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(load(spark, sf_dir, "pages"), URL_RULES)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("item_ids", 256).alias("items_sha256"), "contaminated"
    )


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.digests(load(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_rows(load(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES = {
    name: tuned(query) for name, query in sorted(globals().items()) if name.startswith("op") and name[2].isdigit()
}


CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
    SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS role_out,
        regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS text_out
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length('<|turn|><|text|><|end|>') + length(role_out) + length(text_out))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


DECONTAMINATION_SQL = r"""
WITH said AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM said, sizes, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE len(w) >= size
), hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, win)),
marked AS (SELECT DISTINCT doc_id, j FROM hits, unnest(range(i, i + size)) AS u(j)),
n AS (SELECT doc_id, count(*) AS n_hit FROM marked GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM said LEFT JOIN n USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": CHAT_SQL,
        "op10_decontamination": DECONTAMINATION_SQL,
        "op12_merkle_manifest": merkle.SQL,
        "op13_lexical_search": lexical_search.SQL,
    }
