"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger.session import shared_folder, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name; Python workers get the package first."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    _QUERIES[build.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@query
def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import token_records

    folder = shared_folder(spark, "records")
    index = token_records.write(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_records.with_starts(token_records.read(index, folder), index)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import simhash

    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import embedding_dedup

    return embedding_dedup.groups(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import decontaminate

    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import token_counts

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def fold(name: str, folds: int):
    """crc32 of an id as text, modulo the number of folds."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % folds


@query
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import ppm

    return ppm.score(table(spark, sf_dir, "documents"), held_out=fold("doc_id", 7) == 2)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import quality_cnn as cnn

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    net = cnn.fit(docs, labels.filter(~held_out))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), cnn.quality(net, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cnn.THRESHOLD).cast("int"))


EXAMPLE = "</s>[INST] ok [/INST]"  # a conversation that speaks in control strings


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    example = spark.createDataFrame([(-7, 0, "user", EXAMPLE), (-7, 1, "assistant", EXAMPLE)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(rows.unionAll(example)))
    spoken = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_ORACLES["op8_chat"] = rf"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{EXAMPLE}'
    UNION ALL SELECT -7, 1, 'assistant', '{EXAMPLE}'
), sorted AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
           length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|sep>|/?INST\])')) AS text_size,
           length(role) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|sep>|/?INST\])')) AS role_size
    FROM given
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(text_size + CASE WHEN before = role THEN 5 ELSE role_size + 10 + 8 + 4 END)::BIGINT AS formatted_chars
FROM sorted GROUP BY conv_id
"""

_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import url_rules

    rules = [url_rules.host_rule(*rule) for rule in _RULES]
    return url_rules.judge(table(spark, sf_dir, "pages"), rules, default="allow")


_ORACLES["op10_url_rules"] = rf"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, _RULES))}),
split AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), chosen AS (
    SELECT s.*, (SELECT max(struct_pack(size := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict))
                 FROM rules r
                 WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)) AS best
    FROM split s
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM chosen
"""

_ORACLES["op1_embedding_dedup"] = """
WITH RECURSIVE pairs AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.embedding) = len(b.embedding)
    AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93
), reach(x, y) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), links AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT x AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(y) AS component_id, x = min(y) AS kept
FROM reach LEFT JOIN links USING (x) GROUP BY x
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import prefix_trie

    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


# The checksum is taken byte by byte, from a table of the remainders of 0..255.
_ORACLES["op11_prefix_trie"] = """
WITH RECURSIVE bits(b, k, r) AS (
    SELECT b, 0, b FROM range(256) t(b)
    UNION ALL SELECT b, k + 1, CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM bits WHERE k < 8
), remainders AS (SELECT list(r ORDER BY b) AS t FROM bits WHERE k = 8
), own AS (
    SELECT conv_id AS c, list(coalesce(role, '') ORDER BY turn NULLS FIRST, role) AS roles,
           list(coalesce(text, '') ORDER BY turn NULLS FIRST, role) AS texts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), counted AS (
    SELECT c, roles, texts, xor(list_reduce(
        list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
        lambda a, s: xor(a >> 8, remainders.t[(xor(a, s) & 255) + 1]), 4294967295), 4294967295) % 9 AS h
    FROM own, remainders
), rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.roles[1:o.h], []), o.roles[o.h + 1:]) AS roles,
           list_concat(coalesce(b.texts[1:o.h], []), o.texts[o.h + 1:]) AS texts
    FROM counted o LEFT JOIN own b ON b.c = o.c - o.c % 5
), members AS (
    SELECT c, d, roles[1:d] AS roles, texts[1:d] AS texts, len(texts) = d AS ends
    FROM rebuilt, LATERAL (SELECT unnest(range(len(texts) + 1)) AS d)
), nodes AS (
    SELECT roles, texts, any_value(d) AS d, min(c) AS c, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends) AS ends
    FROM members GROUP BY roles, texts
), tree AS (
    SELECT n.*, p.c AS parent, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.roles[1:n.d] = n.roles AND k.texts[1:n.d] = n.texts) AS children
    FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.roles = n.roles[1:n.d - 1] AND p.texts = n.texts[1:n.d - 1]
), below AS (
    SELECT a.roles, a.texts, count(*) FILTER (WHERE t.children = 0) AS leaves,
           sum(CASE WHEN t.d = 0 THEN 0 ELSE (t.n - 1) * strlen(t.texts[t.d]) END) AS saved
    FROM tree t, LATERAL (SELECT unnest(range(t.d + 1)) AS k) s
    JOIN nodes a ON a.d = s.k AND a.roles = t.roles[1:s.k] AND a.texts = t.texts[1:s.k] GROUP BY a.roles, a.texts
)
SELECT t.c AS conv_id, t.d AS depth, t.parent AS parent_conv_id, t.n AS n_convs, t.children AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM tree t JOIN below b USING (roles, texts)
"""


@query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import wrapper

    return wrapper.extract(table(spark, sf_dir, "pages"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brassledger.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
