"""The registered training-data queries, their parameters and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waferscope.llm import (
    alignment,
    chat,
    decontamination,
    embeddings,
    language,
    packing,
    pii,
    quality,
    simhash,
    token_counts,
    toxicity,
    trie,
    urls,
)
from waferscope.llm.shipping import ship
from waferscope.llm.storage import stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_fold(parts: int) -> Column:
    """crc32 of doc_id written as text, modulo parts; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component: 4-word shingles, at most 4 differing bits."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=4, distance=4)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, with what its output gives back: turns, and the text under the loss mask."""
    control = "\\### Assistant: </turn> ok"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(control).alias("text"))
    # Conversations come in four layouts, which their fingerprints have to tell apart.
    records = chat.records_of(rows.unionByName(probe), layout=F.pmod(F.col("conv_id"), F.lit(4)))
    chats = chat.with_format(chat.with_turns(records))
    turns = chat.read_turns(F.col("formatted"))
    lost = chat.read_under(F.col("formatted"), F.col("loss_spans"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = chats.select("conv_id", "formatted", turns.alias("turns"), lost.alias("lost"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of four folds of five."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(crc_fold(5) == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    found = toxicity.with_scores(docs, model, "text", "doc_id", held_out.alias("held_out"))
    return found.select(
        "doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in power-of-two pieces, each a sequence of its own."""
    made = packing.pieces(table(spark, folder, "documents"), "word_bpe_49k.json", end_id=2, longest=4096)
    # Only the digest of the ids is wanted, so only that is moved to number the pieces.
    digests = made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.numbered(digests)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has over 512."""
    return token_counts.with_token_counts(table(spark, folder, "documents"), "byte_bpe_50k.json", limit=512)


URL_RULES = [
    urls.host_rule("allow", "com/"),
    urls.host_rule("block", "example.com/en/"),
    urls.host_rule("allow", "www.example.com/en/"),
    urls.host_rule("block", "net/es/"),
    urls.host_rule("block", "net/fr/"),
]


def op6_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL judged by the named rules, and by the default ones where none of them fits."""
    return urls.judge(table(spark, folder, "pages"), [*URL_RULES, *urls.DEFAULT_RULES])


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from the documents of two folds of three."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(crc_fold(3) == 1, F.lit(False))
    model = language.train(docs.where(~held_out), per_language=3_000, order=5)
    found = language.with_language(docs, model, "text", "doc_id", held_out.alias("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's links of a cosine of 0.95 or more, and the component they make."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item, the alignment's score and its share of the item."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "share", F.size("spans").alias("n_spans"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data: base spans counted and digested, and all spans."""
    found = pii.find(table(spark, folder, "documents"))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens under two tokenizers, the groups and links between them, and how common the links are."""
    docs = table(spark, folder, "documents")
    return alignment.with_alignment(docs, alignment.align(docs, "byte_bpe_50k.json", "piece_bpe_32k.model"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, learned from the labels of two folds of three."""
    measured = stored(quality.measure(table(spark, folder, "documents")))
    held_out = F.coalesce(crc_fold(3) == 1, F.lit(False))
    model = quality.train(measured, table(spark, folder, "labels").where(~held_out))
    found = quality.with_quality(measured, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation c with the first h turns of conversation c - c % 100, h being crc32(c) % 6, in place of
    its own first h turns; fewer where that one is shorter, none where it is absent."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    heads = convs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, 5).alias("head"))
    met = convs.join(heads, F.expr("conv_id - conv_id % 100") == F.col("head_id"), "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    return met.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie.prefix_trie(stored(rebuilt(trie.conversations(table(spark, folder, "conversations")))))


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'))
          + length(replace(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'))
          + length('### : </turn>') + 1 AS written
  FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(written) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS lost
  FROM escaped GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(lost) AS loss_chars, sha256(lost) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole
"""

URL_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, lower(rest) AS address, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(address, '(^|[^\\p{{L}}\\p{{N}}])({"|".join(urls.BLOCKED_WORDS)})([^\\p{{L}}\\p{{N}}]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


# crc32 by its bits: every character of the id, then eight steps, each marked by -1.
TRIE_SQL = """
WITH said AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({'said': said, 'chars': chars} ORDER BY turn NULLS FIRST, said) AS turns,
         xor(4294967295, list_reduce(
           flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END,
           CAST(4294967295 AS BIGINT))) % 6 AS h
  FROM said GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(turns) AS turns, unnest(generate_series(0, len(turns))) AS depth, turns AS whole FROM rebuilt
), places AS (
  SELECT conv_id, depth, depth = turns AS ends, list_transform(whole[1:depth], lambda t: t.said) AS node,
         CASE WHEN depth > 0 THEN whole[depth].chars ELSE 0 END AS chars FROM prefixes
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM places GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), known AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
), under AS (
  SELECT node[1:up] AS node, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved
  FROM (SELECT *, unnest(generate_series(0, depth)) AS up FROM known)
), summed AS (
  SELECT node, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM under GROUP BY node
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
FROM known k JOIN summed s USING (node) LEFT JOIN known p ON k.depth > 0 AND p.node = k.node[1:k.depth - 1]
"""


def _where_tasks_run(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_simhash": op1_simhash,
        "op2_chat": op2_chat,
        "op3_toxicity": op3_toxicity,
        "op4_packing": op4_packing,
        "op5_token_counts": op5_token_counts,
        "op6_urls": op6_urls,
        "op7_language": op7_language,
        "op8_embeddings": op8_embeddings,
        "op9_decontamination": op9_decontamination,
        "op10_pii": op10_pii,
        "op11_alignment": op11_alignment,
        "op12_quality": op12_quality,
        "op13_trie": op13_trie,
    }
    return {name: _where_tasks_run(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": CHAT_SQL, "op6_urls": URL_SQL, "op13_trie": TRIE_SQL}
