"""The operators applied to whole tables, by query name, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.llm import alignment, bagminhash, encoding, kneser_ney, language, packing, quality, repair, token_counts, topk, toxicity, vectors, warc
from waymeter.llm.shared import remainder
from waymeter.session import new_run_folder

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), narrow=True)
    # The files hold the ids, by length; the answer does not read them.
    return packing.bucketed(packed, new_run_folder(spark, "packing-buckets")).drop("ids")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured"
    )


def learns_toxicity(doc_id: Column) -> Column:
    return remainder(doc_id, 5) != 0


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learns_toxicity)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = new_run_folder(spark, "token-counts")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), cache)


def op6_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.scored(docs, remainder(docs["doc_id"], 7) != 2)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, remainder(docs["doc_id"], 4) != 2)


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.alignment(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_warc, op3_toxicity, op4_bpe, op5_token_counts, op6_embedding_neardup,
        op7_kneser_ney, op8_quality, op9_language_id, op10_bagminhash, op11_topk, op12_repair, op13_alignment)
}

def _bucket(value: str) -> str:
    drop = f"greatest(length(bin({value})) - 6, 0)"
    return f"((({value}) >> {drop}) << {drop})"


def quality_cte(docs: str) -> str:
    """Common table expressions up to `verdicts` (all columns of the relation `docs`, the counts, base_failed, kept)."""
    m = quality.MEASURES
    key = lambda level: ", ".join(("lang_key", "source_key")[:level])
    sketch = " UNION ALL ".join(
        f"SELECT lang_key, source_key, '{name}' AS measure, {_bucket(name)} AS bucket FROM measures WHERE NOT base_failed" for name in m)
    fences = []
    for level in (2, 1, 0):
        part = ", ".join(x for x in (key(level), "measure") if x)
        sides = ", ".join(
            f"max(CASE WHEN measure = '{n}' THEN q1 - {quality.REACH} * greatest(q3 - q1, {least}) END) AS {n}_low, "
            f"max(CASE WHEN measure = '{n}' THEN q3 + {quality.REACH} * greatest(q3 - q1, {least}) END) AS {n}_high" for n, least in m.items())
        outer = f"SELECT {key(level)}{', ' if level else ''} max(total) AS docs, {sides} FROM"
        fences.append(f"""fence{level} AS ({outer} (
            SELECT {part}, min(CASE WHEN upto * 4 >= total THEN bucket END) AS q1,
                   min(CASE WHEN upto * 4 >= total * 3 THEN bucket END) AS q3, max(total) AS total
            FROM (SELECT {part}, bucket, sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {part}) AS total
                  FROM (SELECT {part}, bucket, count(*) AS n FROM sketch GROUP BY {part}, bucket))
            GROUP BY {part}){' GROUP BY ' + key(level) if level else ''})""")
    side = lambda name: (
        f"CASE WHEN f2.docs >= {quality.MIN_DOCS} THEN f2.{name} WHEN f1.docs >= {quality.MIN_DOCS} THEN f1.{name} ELSE f0.{name} END")
    inside = " AND ".join(f"{n} BETWEEN {side(n + '_low')} AND {side(n + '_high')}" for n in m)
    return f"""
        numbered AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS body FROM {docs}),
        split AS (
            SELECT rid, list_filter(regexp_split_to_array(body, '[ \\t-\\r]+'), lambda x: x <> '') AS words,
                   list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines,
                   length(regexp_replace(body, '[ \\t-\\r]', '', 'g')) AS word_chars,
                   length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols
            FROM numbered
        ),
        windows AS (
            SELECT rid, pos, count(*) OVER (PARTITION BY rid, words[pos], words[pos + 1], words[pos + 2]) AS times
            FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 2)) AS pos FROM split)
        ),
        repeats AS (
            SELECT rid, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS place FROM windows WHERE times > 1) GROUP BY rid
        ),
        counts AS (
            SELECT rid, len(words)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM split LEFT JOIN repeats USING (rid)
        ),
        measures AS (
            SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
                   coalesce(1000 * word_chars // nullif(n_words, 0), 0) AS mean_word, coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS symbols,
                   coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_lines,
                   coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeats,
                   coalesce(lang, chr(0)) AS lang_key, coalesce(source, chr(0)) AS source_key
            FROM numbered JOIN counts USING (rid)
        ),
        sketch AS ({sketch}),
        {", ".join(fences)},
        verdicts AS (
            SELECT measures.*, NOT base_failed AND coalesce({inside}, FALSE) AS kept
            FROM measures LEFT JOIN fence2 f2 USING (lang_key, source_key) LEFT JOIN fence1 f1 USING (lang_key) LEFT JOIN fence0 f0 ON TRUE
        )"""


ORACLE: dict[str, str] = {
    "op8_quality": f"""
        WITH {quality_cte("documents")}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts
    """,
    "op2_warc": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html, coalesce(octet_length(encode(html)), 0) AS payload_bytes,
                   url, '2024-01-01'::TIMESTAMP + to_seconds(page_id) AS moment,
                   regexp_replace(split_part(lower(split_part(url, '://', 2)), '#', 1), '^www[.]', '') AS rest
            FROM pages
        ), ranked AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM rows
        )
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND newest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND newest > page_id THEN newest END AS refers_to,
               array_to_string(list_reverse(string_split(regexp_extract(rest, '^[^/?:]*'), '.')), ',') || ')' ||
                   regexp_replace(rest, '^[^/?]*', '') AS urlkey,
               strftime(moment, '%Y%m%d%H%M%S') AS captured
        FROM ranked
    """,
    "op11_topk": """
        WITH whole AS (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), ranked AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
                   row_number() OVER (PARTITION BY q.rid ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
            FROM whole q JOIN whole c ON q.rid <> c.rid
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_repair": """
        WITH RECURSIVE faults AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(
                       list_prepend(4294967295::UBIGINT, list_transform(
                           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::UBIGINT)),
                       lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                                     lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))
                   ), 4294967295::UBIGINT) % 20 AS fault
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (FROM faults UNION ALL FROM faults WHERE fault = 3) WHERE fault <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
                   left(role, 1) AS letter, NOT regexp_matches(text, '[^ \\t-\\r]') AS blank
            FROM damaged
        ), seen AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS times FROM placed
        ), rows AS (
            SELECT *, NOT blank AND times > 1 AS duplicate,
                   NOT blank AND times = 1 AND NOT regexp_matches(text, '[.!?][ \\t-\\r]*$') AS truncated,
                   lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS pair
            FROM seen
        ), counts AS (
            SELECT conv_id, count(i) AS n, coalesce(max(rows.turn) - min(rows.turn) + 1 - count(DISTINCT rows.turn), 0)::BIGINT AS gaps,
                   count_if(blank)::BIGINT AS blank, count_if(duplicate)::BIGINT AS duplicate, count_if(truncated)::BIGINT AS truncated,
                   count(CASE WHEN pair NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal
            FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN rows USING (conv_id) GROUP BY conv_id
        ), letters(q, letter, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
        ), inserted(q, r, n, edits, lines) AS (
            SELECT * FROM (VALUES (0, 2, 1, 'I', chr(10) || 'user:'), (1, 2, 1, 'I', chr(10) || 'user:'), (2, 3, 1, 'I', chr(10) || 'assistant:'),
                (3, 2, 1, 'I', chr(10) || 'user:'), (0, 3, 2, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                (1, 3, 2, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')) UNION ALL SELECT q, q, 0, '', '' FROM range(4) t(q)
        ), way AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS q, struct_pack(cost := 0, audit := '', lines := '') AS best FROM counts
            UNION ALL
            SELECT way.conv_id, way.i + 1, edit.r, min(struct_pack(
                cost := best.cost + 3 * inserted.n + edit.cost, audit := best.audit || inserted.edits || edit.edit, lines := best.lines || inserted.lines || edit.line))
            FROM way JOIN inserted ON way.q = inserted.q JOIN (
                SELECT conv_id, i, q, q AS r, 4 AS cost, 'D' AS edit, '' AS line FROM rows, range(4) t(q)
                UNION ALL
                SELECT conv_id, i, q, r, CASE WHEN rows.letter = letters.letter THEN 0 ELSE 3 END + CASE WHEN truncated THEN 3 ELSE 0 END,
                       CASE WHEN rows.letter = letters.letter THEN 'K' ELSE 'R' END,
                       chr(10) || CASE WHEN rows.letter = letters.letter THEN role WHEN letters.letter = 'u' THEN 'user' ELSE 'assistant' END || ':' || text
                FROM rows, letters WHERE NOT blank AND NOT duplicate AND (rows.letter = letters.letter OR letters.letter <> 's')
            ) edit ON edit.conv_id IS NOT DISTINCT FROM way.conv_id AND edit.i = way.i + 1 AND edit.q = inserted.r
            GROUP BY way.conv_id, way.i, edit.r
        ), ended AS (
            SELECT way.conv_id, min(struct_pack(cost := best.cost + 3 * inserted.n, audit := best.audit || edits, lines := best.lines || inserted.lines)) AS best
            FROM way JOIN counts ON way.conv_id IS NOT DISTINCT FROM counts.conv_id AND way.i = counts.n
            JOIN inserted ON way.q = inserted.q AND inserted.r IN (0, 3) GROUP BY way.conv_id
        )
        SELECT counts.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost::BIGINT AS cost, best.audit AS audit,
               sha256(substr(best.lines, 2)) AS repaired_sha256
        FROM counts JOIN ended ON counts.conv_id IS NOT DISTINCT FROM ended.conv_id
    """,
}
