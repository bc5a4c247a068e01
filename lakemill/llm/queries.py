"""The operators as queries over the driver tables, with SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import (
    chat,
    contamination,
    divergence,
    exact_dedup,
    language,
    licenses,
    mixing,
    order_minhash,
    prefix_trie,
    substring,
    token_files,
    toxicity,
    warc,
)
from lakemill.llm.common import hash_remainder, keep, ship_package, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def held_out(modulus: int, remainder: int) -> Column:
    """Rows that nothing is learned from; an id that is null is not held out."""
    return F.coalesce(hash_remainder("doc_id", modulus) == remainder, F.lit(False))


@_query()
def op1_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    away = held_out(5, 0)
    model = toxicity.char_model(toxicity.learn_characters(docs))
    # restored once: the labels and the scores both start from the words
    words = toxicity.restored_words(docs, model, F.col("text"))
    restored = keep(docs.select("doc_id", away.alias("held_out"), words.alias("words")), "restored", compression="zstd")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    # as many labels as documents: never a side to broadcast
    labelled = restored.where(~F.col("held_out")).join(labels.hint("merge"), "doc_id")
    scored = toxicity.score(restored, *toxicity.learn_words(labelled))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@_query()
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    away = held_out(4, 2)
    profiles = language.learn_profiles(docs.where(~away))
    found = language.predict(docs, profiles, "text", F.col("doc_id"), away.alias("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_query()
def op3_license_scan(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents"))
    best = F.get("found", F.lit(0))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size(F.array_distinct(F.transform("found", lambda f: f["license"]))).alias("n_licenses"),
        best["license"].alias("license"),
        best["coverage"].alias("coverage"),
        best["start"].alias("start"),
        best["stop"].alias("stop"),
        "found",
    )


#: Said by both turns of the extra conversation.
CONTROL_STRINGS = "</s>[INST] ok [/INST]"


@_query(r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
    SELECT *, regexp_replace(replace(text, '\', '\\'), '(<|\[)(/?s>|/?INST\])', '\1\\\2', 'g') AS text_out,
        regexp_replace(replace(role, '\', '\\'), '(<|\[)(/?s>|/?INST\])', '\1\\\2', 'g') AS role_out
    FROM turns
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')
            AS replies,
        3 + sum(length(text_out) + length(role_out) + 17)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(replies) AS loss_chars,
    sha256(replies) AS loss_sha256, formatted_chars
FROM whole
""")
def op4_chat_prefix_targets(spark, sf):
    conversations = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_STRINGS), (-1, 1, "assistant", CONTROL_STRINGS)], conversations.schema
    )
    return chat.digest_examples(chat.format_turns(conversations.unionByName(extra)))


@_query("""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response
    FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
FROM payloads
""")
def op5_warc_round_trip(spark, sf):
    folder = warc.archive_folder(spark)
    return warc.read(warc.write(table(spark, sf, "pages"), folder), folder)


@_query()
def op6_mix_sources(spark, sf):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return mixing.mix(table(spark, sf, "documents")).select(*columns)


@_query(r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, list_slice(words, s, s + 9) AS phrase
    FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS s FROM items WHERE len(words) > 0)
), lengths AS (
    SELECT DISTINCT len(phrase) AS n FROM windows
), found AS (
    SELECT doc_id, s, n, item_id
    FROM (
        SELECT doc_id, s, n, list_slice(words, s, s + n - 1) AS phrase
        FROM (SELECT doc_id, words, n, unnest(range(1, greatest(1, len(words) - n + 2))) AS s FROM docs, lengths)
    ) JOIN windows USING (phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op7_decontaminate(spark, sf):
    found = contamination.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

@_query(r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY list_slice(words, s, s + 19) ORDER BY doc_id, s) AS nth
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM docs WHERE len(words) >= 20)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS pos FROM windows WHERE nth > 1
), per_word AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
    FROM per_word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
""")
def op8_substring_dedup(spark, sf):
    found = substring.remove_repeats(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@_query()
def op9_near_duplicates(spark, sf):
    found = order_minhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size")


@_query(r"""
WITH docs AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
), marked AS (
    SELECT doc_id, body,
        first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size
    FROM docs
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM marked
""")
def op10_exact_dedup(spark, sf):
    marked = exact_dedup.mark_duplicates(table(spark, sf, "documents"))
    return marked.selectExpr("id AS doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query(r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || t)) AS said,
        -- CRC-32 of the decimal id, a byte and a bit at a time
        xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                lambda v, bit: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
    FROM turns GROUP BY conv_id
), built AS (
    SELECT o.conv_id,
        list_concat(list_slice(coalesce(b.said, []), 1, o.h), list_slice(o.said, o.h + 1, len(o.said))) AS said
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
    SELECT conv_id, d AS depth, list_slice(said, 1, d) AS path, len(said) = d AS ends
    FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM built)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ended,
        CASE WHEN depth > 0 THEN list_slice(path, 1, depth - 1) END AS parent
    FROM prefixes GROUP BY path, depth
), children AS (
    SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
), graded AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children,
        (n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].t) ELSE 0 END AS saved
    FROM nodes LEFT JOIN children ON children.parent = nodes.path
), sums AS (
    SELECT list_slice(path, 1, d) AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS d FROM graded) GROUP BY top
)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, n_leaves, saved_tokens,
    sha256(g.ended) AS ends_sha256
FROM graded g JOIN sums ON sums.top = g.path LEFT JOIN nodes p ON p.path = g.parent
""")
def op11_conversation_trie(spark, sf):
    turns = prefix_trie.turn_rows(table(spark, sf, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.share_openings(turns))


@_query()
def op12_token_files(spark, sf):
    from public_tokenizers import path

    folder = warc.archive_folder(spark, "token-ids")
    manifest = token_files.write(table(spark, sf, "documents"), folder, path("byte_bpe_50k.json"))
    return token_files.read(manifest, folder)


@_query(r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), per_doc AS (
    SELECT lang, source, term, sum(n) AS n, count(*) AS docs
    FROM (
        SELECT id, lang, source, term, count(*) AS n
        FROM (SELECT id, lang, source, unnest(words) AS term FROM (SELECT row_number() OVER () AS id, * FROM docs))
        GROUP BY ALL
    ) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n)::HUGEINT AS n FROM per_doc GROUP BY ALL HAVING sum(docs) >= 30
), langs AS (
    SELECT lang, sum(n)::HUGEINT AS total, count(*) AS v FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), totals AS (
    SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
    FROM groups LEFT JOIN (SELECT p.* FROM per_doc p SEMI JOIN kept USING (lang, term)) USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT t.lang, t.source, k.term, coalesce(p.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(p.n, 0) + 5)) // (t.total + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
    FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN per_doc p ON p.lang = t.lang AND p.source = t.source AND p.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
) WHERE part = 'pair' OR rank <= 50
""")
def op13_source_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))
