"""The queries of the text operators: (spark, sf_dir) -> DataFrame, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOKENIZERS = {"bytes": "byte_bpe_50k.json", "words": "word_bpe_49k.json", "pieces": "piece_bpe_32k.model"}


def vocabulary(kind: str) -> str:
    """Where this machine keeps a public vocabulary file; operators take any other path as well."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZERS[kind])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import digest, scan_versions

    return digest(scan_versions(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    return identify(table(spark, sf_dir, "documents"), vocabulary("pieces"))


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import store_tokens

    return store_tokens(table(spark, sf_dir, "documents"), vocabulary("bytes"), end=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import digest, without_repeats

    return digest(without_repeats(table(spark, sf_dir, "documents")))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op8_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_quotes import linked

    return linked(table(spark, sf_dir, "conversations"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("words"), end=1)


QUERIES = {"op1_secret_scan": op1_secret_scan, "op2_language_id": op2_language_id, "op3_token_planes": op3_token_planes, "op4_decontamination": op4_decontamination, "op5_toxicity": op5_toxicity, "op6_suffix_dedup": op6_suffix_dedup, "op7_nearest": op7_nearest, "op8_quotations": op8_quotations, "op9_near_duplicates": op9_near_duplicates, "op10_packing": op10_packing}
ORACLE_SQL: dict[str, str] = {
    "op8_quotations": r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () rid, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) lines FROM conversations),
 l AS (SELECT rid, conv_id, turn, unnest(lines) line, generate_subscripts(lines, 1) i FROM m),
 p AS (SELECT rid, conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) level, regexp_replace(line, '^([ \t]*>)+[ \t]?', '') t FROM l),
 g AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY i) - row_number() OVER (PARTITION BY rid, level ORDER BY i) run FROM p),
 q AS (SELECT rid, conv_id, turn, level, min(i) first_line, string_agg(t, chr(10) ORDER BY i) t FROM g GROUP BY rid, conv_id, turn, level, run),
 n AS (SELECT *, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) h FROM q),
 k AS (SELECT a.rid, a.level, a.h, max(b.turn) turn FROM n a JOIN n b ON a.conv_id = b.conv_id AND a.h = b.h AND b.level = 0 AND b.turn < a.turn WHERE a.level > 0 AND a.h <> '' GROUP BY 1, 2, 3),
 f AS (SELECT rid, turn quoted, count(*) OVER (PARTITION BY rid) n_linked FROM k QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level, turn DESC) = 1),
 b AS (SELECT rid, trim(coalesce(string_agg(t, chr(10) ORDER BY first_line) FILTER (level = 0), '')) body, cast(max(level) AS int) quote_depth, count(*) FILTER (level > 0) n_quotes FROM q GROUP BY rid),
 d AS (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
 w AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) earlier, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS "position" FROM d),
 y AS (SELECT m.rid, m.conv_id, m.turn, w."position", coalesce(quoted, earlier) reply_to, coalesce(n_linked, 0) n_linked FROM m LEFT JOIN f USING (rid) LEFT JOIN w ON m.conv_id = w.conv_id AND m.turn = w.turn),
 e AS (SELECT conv_id, turn, max(reply_to) parent FROM y WHERE "position" IS NOT NULL GROUP BY 1, 2),
 z AS (SELECT conv_id, turn, turn root, 0::bigint depth FROM e WHERE parent IS NULL UNION ALL SELECT e.conv_id, e.turn, z.root, z.depth + 1 FROM e JOIN z ON e.conv_id = z.conv_id AND e.parent = z.turn)
SELECT m.conv_id, m.turn, m.role, body, y.reply_to, CASE WHEN y."position" IS NOT NULL THEN coalesce(z.root, m.turn) END root, CASE WHEN y."position" IS NOT NULL THEN coalesce(z.depth + 1, 0) END depth, y."position", quote_depth, n_quotes, y.n_linked, '<|' || coalesce(m.role, '') || '|>' || chr(10) || body markup
FROM m JOIN b USING (rid) JOIN y USING (rid) LEFT JOIN z ON m.conv_id = z.conv_id AND y.reply_to = z.turn""",
}
