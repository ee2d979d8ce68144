"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from areapulse.llm import chaining, language, mixing, negatives, packing, prefixes, records, recurrent, rules, secrets, simhash, topk, warc
from areapulse.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(table(spark, sf_dir, "documents"))
    return records.read_records(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.sized_leaves(table(spark, sf_dir, "documents"))
    return mixing.mixed(sized, mixing.plan(sized))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.scored(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), label)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a source is an owner, and its texts of one language are a repository
    return secrets.scanned(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang"), F.col("source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_top_k": op3_top_k,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash": op5_simhash,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_token_records": op7_token_records,
    "op8_source_mixture": op8_source_mixture,
    "op9_language_model": op9_language_model,
    "op10_language": op10_language,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_secrets": op13_secrets,
}


def _secrets_sql() -> str:
    def matches(kind: int, pattern: str, least: int) -> str:
        quoted = f"(?s)(.*?)({pattern})".replace("'", "''")
        part = lambda group: f"unnest(regexp_extract_all(text, '{quoted}', {group}))"
        return f"""
          SELECT row, {kind} AS kind, {least} AS least, {part(1)} AS gap, {part(2)} AS whole, {part(3)} AS value,
                 unnest(range(len(regexp_extract_all(text, '{quoted}', 2)))) AS n FROM docs"""

    every = " UNION ALL ".join(matches(i, pattern, least) for i, (_, pattern, least) in enumerate(secrets.BASE + secrets.MORE))
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{name}" for i, (name, _, _) in enumerate(secrets.BASE))
    joined = "coalesce(string_agg(span, ',' ORDER BY start, kind){}, '')"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, concat_ws('/', source, lang) AS repository, source AS owner FROM documents),
        matches AS ({every}),
        placed AS (SELECT row, kind, least, value, n, length(whole) AS size,
                          sum(length(gap) + length(whole)) OVER (PARTITION BY row, kind ORDER BY n) AS until FROM matches),
        long AS (SELECT row, kind, value, CAST(until - size AS BIGINT) AS start, CAST(until AS BIGINT) AS until, kind < {len(secrets.BASE)} AS base FROM placed WHERE length(value) >= least),
        every_one AS (SELECT l.* FROM long l WHERE base OR (
            len(list_distinct(string_split(value, ''))) >= {secrets.VARIED} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
            AND NOT EXISTS (SELECT 1 FROM long b WHERE b.base AND b.row = l.row AND b.start < l.until AND l.start < b.until))),
        owned AS (SELECT value, owner, count(*) AS n FROM (SELECT DISTINCT value, repository, owner FROM every_one JOIN docs USING (row)) GROUP BY ALL),
        census AS (SELECT value, count(*) <= {secrets.MOST_OWNERS} AND sum(n) <= {secrets.MOST_REPOSITORIES} AS live FROM owned GROUP BY value),
        judged AS (SELECT *, concat_ws(':', {names}[kind + 1], start, until) AS span FROM every_one JOIN census USING (value) WHERE base OR live),
        counted AS (SELECT row, {counts}, {joined.format(' FILTER (base)')} AS base_spans, {joined.format('')} AS spans,
                           count(*) FILTER (live) AS n_live, count(*) FILTER (base AND NOT live) AS n_copied FROM judged GROUP BY row)
        SELECT doc_id, {", ".join(f"coalesce(n_{name}, 0) AS n_{name}" for name, _, _ in secrets.BASE)}, sha256(coalesce(base_spans, '')) AS base_sha256,
               coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
        FROM docs LEFT JOIN counted USING (row)
    """


SQL: dict[str, str] = {
    "op1_warc": """
        WITH keyed AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             firsts AS (SELECT html, min(page_id) AS first_id FROM keyed GROUP BY html),
             hex AS (SELECT k.page_id, octet_length(encode(k.html)) AS payload_bytes, f.first_id, sha1(k.html) AS h
                     FROM keyed k JOIN firsts f USING (html)),
             bits AS (SELECT *, list_transform(range(0, 8), lambda i:
                        ('0x' || substr(h, CAST(1 + 5 * i AS BIGINT), 5))::BIGINT) AS parts FROM hex)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda j:
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                        CAST(1 + ((parts[CAST(1 + j // 4 AS BIGINT)] >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31) AS BIGINT), 1)),
                 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM bits
    """,
    "op3_top_k": """
        WITH ints AS (
          SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
          FROM ints a JOIN ints b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_hard_negatives": """
        WITH rows AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))::DOUBLE[] AS q
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
          SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
          FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
            AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
    "op12_prefix_trie": """
        WITH step AS (
          SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
            FROM range(256) r(i))),
        turns AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) - 1 AS place, digest, bytes
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, octet_length(encode(coalesce(text, ''))) AS bytes,
                       sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
                FROM conversations WHERE conv_id IS NOT NULL)),
        sizes AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base FROM turns GROUP BY conv_id),
        plan AS (
          SELECT s.*, least(h, coalesce(b.n, 0)) AS taken FROM (
            SELECT sizes.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                                            lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 AS h
            FROM sizes, step) s LEFT JOIN (SELECT conv_id AS base, n FROM sizes) b USING (base)),
        whole AS (
          SELECT p.conv_id, place, digest, bytes FROM plan p JOIN turns t ON t.conv_id = p.base AND t.place < p.h
          UNION ALL
          SELECT p.conv_id, place - h + taken, digest, bytes FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.h),
        path AS (
          SELECT conv_id, place + 1 AS depth, md5(string_agg(digest, '') OVER w) AS node, bytes FROM whole WINDOW w AS (PARTITION BY conv_id ORDER BY place)
          UNION ALL SELECT conv_id, 0, 'root', 0 FROM sizes),
        up AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS above, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM path),
        nodes AS (
          SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
          FROM up GROUP BY depth, node),
        children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        subtree AS (
          SELECT p.depth, p.node, sum((u.n_convs - 1) * u.bytes) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves
          FROM nodes u LEFT JOIN children c ON c.depth = u.depth AND c.node = u.node JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth
          GROUP BY ALL)
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.leaves AS n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN subtree s ON s.depth = n.depth AND s.node = n.node
        LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
        LEFT JOIN nodes m ON m.depth = n.depth - 1 AND m.node = n.above
    """,
    "op13_secrets": _secrets_sql(),
}
