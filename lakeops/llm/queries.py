"""One query per operator over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path

from . import (bin_slack, decontaminate, exact_dedup, html_text, language_id, licence_scan, prefix_trie,
               sentencepiece_nbest, sharding, simhash, spelling, token_counts, token_files)

SHARDS = 40
TOKEN_LIMIT = 512
BEST = 3
WINDOW = 4096


def vocabulary(name: str) -> str:
    """A public tokenizer's file, installed beside the libraries on every machine."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its licences, the best Dice and the number of matches."""
    found = licence_scan.scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_sort(F.array_distinct(F.col("matches.licence"))).alias("licences"),
                        F.coalesce(F.array_max("matches.dice"), F.lit(0.0)).alias("best_dice"),
                        F.size("matches").alias("n_matches"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                              limit=TOKEN_LIMIT)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    rows = docs.select("doc_id", "text", language_id.held_out("doc_id").alias("held_out"))
    return language_id.predict(rows, model).drop("text")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with exact_dedup.DigestIndex(spark) as index:
        return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), index)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the best segmentations' scores, lengths and checksums, and whether the best decodes to the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_nbest.encode_nbest(docs, vocabulary("piece_bpe_32k.model"), BEST, ids=None,
                                            memo=700_000, keep_text=False).select(
        "doc_id", F.col("nbest")[0]["n_pieces"].alias("n_tokens"), "nbest", "decoded")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), path, end_id=2)
    return token_files.read_token_files(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, their ids as a checksum."""
    pieces = bin_slack.packed_pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), WINDOW, end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_licences, op3_sharding, op4_token_counts, op5_language_id,
                                   op6_decontamination, op7_html_text, op8_exact_dedup, op9_sentencepiece,
                                   op10_token_files, op11_prefix_trie, op12_bin_slack, op13_spelling)}

# CRC-32 has no function in the oracle's SQL: its table, and a fold over a text's UTF-8 bytes
_CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                 ORDER BY i) AS steps FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    octets = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


ORACLES = {
    "op8_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, digest AS text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest
              FROM documents)
        WINDOW same AS (PARTITION BY digest)""",
    "op11_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, turn, sha256(strlen(r) || ':' || r || x) AS content, strlen(x) AS n_bytes
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)
            WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id, list(content ORDER BY turn NULLS FIRST, content) AS contents,
                   list(n_bytes ORDER BY turn NULLS FIRST, content) AS sizes
            FROM turns GROUP BY conv_id),
        heads AS (
            SELECT o.*, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM own o, {_CRC_TABLE}),
        built AS (
            SELECT c.conv_id,
                   list_concat(coalesce(b.contents, [])[1:c.h], c.contents[c.h + 1:]) AS contents,
                   list_concat(coalesce(b.sizes, [])[1:c.h], c.sizes[c.h + 1:]) AS sizes
            FROM heads c LEFT JOIN own b ON b.conv_id = c.base),
        passed AS (
            SELECT conv_id, depth, sha256(array_to_string(contents[1:depth], ',')) AS node,
                   sha256(array_to_string(contents[1:depth - 1], ',')) AS parent,
                   CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS n_bytes, depth = len(contents) AS ends
            FROM built, unnest(range(0, len(contents) + 1)) AS d(depth)),
        nodes AS (
            SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * max(n_bytes) AS weight,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM passed GROUP BY depth, node),
        kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        full_nodes AS (
            SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (depth, node)),
        below AS (
            SELECT p.depth, p.node, sum(u.weight)::BIGINT AS saved, count(*) FILTER (WHERE u.n_children = 0) AS leaves
            FROM full_nodes u JOIN passed p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY ALL)
        SELECT n.conv_id, n.depth, above.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.leaves AS n_leaves,
               b.saved AS saved_tokens, n.ends_sha256
        FROM full_nodes n JOIN below b USING (depth, node)
        LEFT JOIN full_nodes above ON n.depth > 0 AND above.depth = n.depth - 1 AND above.node = n.parent""",
    "op13_spelling": rf"""
        WITH RECURSIVE runs AS (
            SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
                  FROM documents)),
        hashed AS (
            SELECT run, n, {_crc32("key")} AS h
            FROM (SELECT run, id || ':' || run AS key, count(*) AS n FROM runs GROUP BY ALL), {_CRC_TABLE}),
        words AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                              ELSE run END AS word, n FROM hashed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        gaps AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap FROM words, unnest(range(1, length(word) + 1)) AS p(i)),
        near AS (
            SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
            UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.gap
            UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.gap),
        ranked AS (
            SELECT near.word, near.near, f.n AS near_n, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
                   row_number() OVER (PARTITION BY near.word ORDER BY f.n DESC, near.near) AS place
            FROM near JOIN words f ON f.word = near.near JOIN words w ON w.word = near.word),
        forms AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
                   CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
        follow(word, last) AS (
            SELECT word, word FROM forms
            UNION ALL SELECT follow.word, forms.form FROM follow JOIN forms ON forms.word = follow.last WHERE forms.form IS NOT NULL)
        SELECT f.word, f.form, l.last AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN follow l ON l.word = f.word JOIN forms e ON e.word = l.last AND e.form IS NULL""",
}
