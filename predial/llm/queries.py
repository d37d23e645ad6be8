"""The queries of the operators and their SQL, registered by the entry point."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    jaccard_join,
    langid,
    packing,
    pii,
    prefix_trie,
    quality,
    sharding,
    topk_search,
    warc,
    whitening,
)
from predial.llm.support import crc_of_id, keep, prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""


@query
def op8_sharding(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(documents, "doc_id")


def _sharding_sql() -> str:
    """The hash and the placement in SQL; the table's owners are written out."""
    owners = ",".join(map(str, sharding.lookup_table(sharding.SHARDS)))
    return f"""
WITH t AS (SELECT [{owners}] AS owners),
d AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS varchar), '')), 1, 15))::BIGINT
             % {sharding.SLOTS} AS integer) AS slot FROM documents)
SELECT doc_id, slot, CAST(owners[slot + 1] AS integer) AS shard,
       'shard-' || lpad(CAST(owners[slot + 1] AS varchar), 3, '0') AS shard_name
FROM d, t
"""


ORACLES["op8_sharding"] = _sharding_sql()


@query
def op9_byte_bpe(spark, sf_dir):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    decoded = byte_bpe.decode(encoded, path, pattern)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    documents = table(spark, sf_dir, "documents")
    return packing.pack(documents, path, with_ids=False).drop("ids")


@query
def op7_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(3)) == 1, F.lit(False))
    weights = quality.train(documents, table(spark, sf_dir, "labels"), teaches=~held_out)
    scored = quality.with_score(documents.select("doc_id", "text"), weights)
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


@query
def op10_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(4)) == 2, F.lit(False))
    model = langid.train(documents.filter(~held_out))
    found = langid.identify(documents, *model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _listed(spans: str):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def _count_of(kind: str):
    return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")


@query
def op6_personal_data(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = pii.find(documents, pii.train(documents))
    counts = [_count_of(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    base = F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, _listed("spans").alias("spans"))


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.link(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op3_topk_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op3_topk_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS bigint) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer)
           AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op4_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages)
    records = warc.read_pages(archive, warc.keys_of(pages)).drop("payload")
    return warc.resolved(keep(records, "read")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op11_chat_formatting(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marks).alias("text"),
    )
    return chat.digests(chat.format_chats(conversations.unionByName(extra)))


def _chat_sql() -> str:
    """Blocks are counted by a window; lengths are of texts escaped as the template does."""
    t = chat.CHATML
    pattern = t.pattern(False)
    a_block, a_turn = len(t.start + t.role_end + t.end), len(t.turn)
    return rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
    SELECT *, row_number() OVER w AS nth, role IS DISTINCT FROM lag(role) OVER w AS opens,
           length(regexp_replace(txt, '{pattern}', '\1\\\2\3', 'g')) AS chars,
           length(regexp_replace(role, '{pattern}', '\1\\\2\3', 'g')) AS role_chars
    FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt)),
g AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || txt || chr(10), '' ORDER BY nth) AS lines,
           coalesce(string_agg(txt, '' ORDER BY nth) FILTER (WHERE role = '{t.loss_role}'), '') AS loss,
           sum(chars + CASE WHEN opens THEN role_chars + {a_block} ELSE {a_turn} END) AS formatted_chars
    FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(loss) AS bigint) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS bigint) AS formatted_chars
FROM g
"""


ORACLES["op11_chat_formatting"] = _chat_sql()


def _rebuilt(turns: DataFrame) -> DataFrame:
    """The first h turns of conversation c - c % 100, then those of c after its first h."""
    turns = keep(turns, "turns")
    # Not more than five turns of every hundredth conversation, each for a hundred others.
    heads = turns.filter("conv_id % 100 = 0").select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, 5).alias("head")
    )
    h = F.pmod(crc_of_id("conv_id"), F.lit(6)).cast("int")
    both = turns.withColumn("h", h).withColumn("head_id", F.expr("conv_id - conv_id % 100"))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return both.join(heads, "head_id", "left").select(
        "conv_id", F.concat(head, rest).alias("turns")
    )


@query
def op12_prefix_trie(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return prefix_trie.trie(_rebuilt(prefix_trie.turns_of(conversations)))


# crc32 of ASCII digits, bit by bit (0xEDB88320 is the fixed value of its polynomial); nodes
# are lists of turns, and each one is joined to all of its prefixes.
ORACLES["op12_prefix_trie"] = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt
    FROM conversations WHERE conv_id IS NOT NULL),
o AS (
    SELECT conv_id, list({'role': role, 'txt': txt} ORDER BY turn NULLS FIRST, role,
        sha256(strlen(role) || ':' || role || txt)) AS turns FROM t GROUP BY conv_id),
c AS (
    SELECT conv_id, turns, CAST(xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS varchar), ''),
            lambda d: CAST(ascii(d) AS UBIGINT))),
        lambda s, b: list_reduce(list_prepend(xor(s, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)
    )) % 6 AS bigint) AS h FROM o),
r AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r),
n AS (
    SELECT turns[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '') AS ends
    FROM p GROUP BY ALL),
k AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.key[depth].txt) END AS saved
    FROM n LEFT JOIN k ON n.key = k.key),
u AS (SELECT f.*, unnest(range(0, depth + 1)) AS up FROM f),
s AS (
    SELECT key[1:up] AS key, CAST(sum(saved) AS bigint) AS saved_tokens,
           count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM u GROUP BY 1)
SELECT f.conv_id, f.depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       s.saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s ON s.key = f.key LEFT JOIN n a ON a.depth = f.depth - 1 AND a.key = f.key[1:f.depth - 1]
"""


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
