"""One registered query per operator, over its whole table, and the SQL of
those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.llm import bpe, chunks, codes, embeddings, html, minhash, mixing, nearest, quality, repair, rules, secrets, toxicity
from vintage.llm.common import table


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _held_out(parts: int, rest: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == rest


def _labels(spark: SparkSession, sf_dir: str, parts: int, rest: int) -> DataFrame:
    """The labels that may be learnt from."""
    return table(spark, sf_dir, "labels").filter(~_held_out(parts, rest))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fifths of the ids are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, _labels(spark, sf_dir, 5, 0), "toxic"))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; quarters of the ids are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, _labels(spark, sf_dir, 4, 2), "quality"))
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat, with the documents and places that hold them."""
    return chunks.repeated(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. Null text: none. Spans by code points."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return found.select(
        "doc_id", *[secrets.counted(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector (equal labels, cosine 0.93); a row
    without an id is kept where no row of its component has one."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (two-word shingles, 0.8); a
    row without an id is kept where no row of its component has one."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rule and verdict of every document."""
    judged = rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")])


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.train(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, vocabulary(), decoded_col="decoded")
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every damaged conversation."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    found = repair.repairs(rows)
    digest = repair.digests(rows, found).withColumnRenamed("conv_id", "of")
    return found.join(digest, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every vector, its error, and the final codebooks' digest."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.label_errors(coded).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest.search(rows, rows.filter(F.col("vec_id") % 20 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scans": op3_secret_scans,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_bpe_encoding": op10_bpe_encoding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

def _codes_sql(rounds: int = 4) -> str:
    """Assignments and means, one after the other, in whole numbers."""
    steps = ["""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 4 = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
shape AS (SELECT len(embedding) AS width FROM kept ORDER BY vec_id NULLS LAST, len(embedding) LIMIT 1),
alike AS MATERIALIZED (SELECT row_number() OVER (ORDER BY rid) AS rid, vec_id, label, embedding, width FROM kept, shape WHERE len(embedding) = width),
comp AS MATERIALIZED (SELECT rid, (i - 1) // (width // 4) AS part, (i - 1) % (width // 4) AS pos, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
    FROM (SELECT *, unnest(range(1, width + 1)) AS i FROM alike)),
book0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, v AS c FROM comp WHERE rid <= 256)"""]
    for t in range(rounds + 1):
        steps.append(f"""near{t} AS MATERIALIZED (SELECT rid, part, min({{'d': d, 'e': entry}}) AS best FROM (
    SELECT a.rid, a.part, b.entry, CAST(sum((a.v - b.c) * (a.v - b.c)) AS BIGINT) AS d FROM comp a JOIN book{t} b USING (part, pos)
    GROUP BY a.rid, a.part, b.entry) GROUP BY rid, part)""")
        if t < rounds:
            steps.append(f"""book{t + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN s.n IS NULL THEN b.c ELSE (s.total - ((s.total % s.n) + s.n) % s.n) // s.n END AS c
    FROM book{t} b LEFT JOIN (SELECT c.part, n.best.e AS entry, c.pos, CAST(sum(c.v) AS BIGINT) AS total, count(*) AS n
    FROM comp c JOIN near{t} n USING (rid, part) GROUP BY c.part, n.best.e, c.pos) s USING (part, entry, pos))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT a.rid, a.vec_id, a.label, string_agg(lower(printf('%02x', n.best.e)), '' ORDER BY n.part) AS code, CAST(sum(n.best.d) AS BIGINT) AS error
    FROM alike a JOIN near{rounds} n USING (rid) GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256 FROM coded"""


ORACLE_SQL: dict[str, str] = {
    "op5_source_mixing": """
WITH base AS (SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM base GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rk - 1) % 3 + 1] AS w, CAST(2 * source_size AS DOUBLE) AS cap FROM per),
levels AS (SELECT *, row_number() OVER (ORDER BY cap / w, rk) AS cr,
    (sum(cap) OVER () * 0.75::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS lvl
    FROM weighed),
goal AS (SELECT source, source_size, coalesce(least(cap, w * (SELECT arg_min(lvl, cr) FROM levels WHERE lvl * w <= cap)), cap) AS target FROM levels),
placed AS (SELECT b.*, g.source_size, g.target, coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY k, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS passes FROM placed)
SELECT doc_id, size, source_size, target,
    CAST(passes * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - passes * source_size - ahead)) AS BIGINT) AS taken
FROM cut""",
    "op6_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS node FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.node),
comp AS (SELECT vec_id, min(node) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS BIGINT) AS n_links, c.component_id,
    e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.vec_id = e.vec_id""",
    "op11_conversation_repair": """
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fated AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fate FROM keyed, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fated WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt),
judged AS (SELECT *, left(role, 1) AS a, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
    count(*) FILTER (before || a NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
adds(s, m, k, said) AS (VALUES (0, 0, 0, ''), (0, 2, 1, chr(10) || 'user:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 1, 0, ''), (1, 2, 1, chr(10) || 'user:'), (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (2, 2, 0, ''), (2, 3, 1, chr(10) || 'assistant:'), (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:'),
    (3, 3, 0, ''), (3, 2, 1, chr(10) || 'user:'), (3, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:')),
eats(m, a, t, given) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
edits AS (SELECT m, 'K' AS letter, a, t, NULL AS given, 0 AS cost FROM eats UNION ALL SELECT m, 'R', NULL, t, given, 2 FROM eats WHERE given IS NOT NULL
    UNION ALL SELECT s, 'D', NULL, s, NULL, 3 FROM (SELECT DISTINCT s FROM adds)),
walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'c': CAST(0 AS BIGINT), 'w': '', 'o': ''} AS best FROM faults
    UNION ALL
    SELECT w.conv_id, w.i + 1, e.t, min({'c': CAST(w.best.c + 2 * d.k + e.cost + CASE WHEN j.cut AND e.letter <> 'D' THEN 1 ELSE 0 END AS BIGINT),
        'w': w.best.w || repeat('I', d.k) || e.letter,
        'o': w.best.o || d.said || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || j.role || ':' || j.text ELSE chr(10) || e.given || ':' || j.text END})
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1 JOIN adds d ON d.s = w.state
    JOIN edits e ON e.m = d.m AND (e.a IS NULL OR e.a = j.a) AND (e.letter = 'D' OR NOT (j.blank OR j.again))
    GROUP BY w.conv_id, w.i, e.t),
ends AS (SELECT f.conv_id, min({'c': CAST(w.best.c + 2 * d.k AS BIGINT), 'w': w.best.w || repeat('I', d.k), 'o': w.best.o || d.said}) AS best
    FROM faults f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n JOIN adds d ON d.s = w.state AND d.m IN (0, 3) GROUP BY f.conv_id)
SELECT c.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
    coalesce(f.illegal, 0) AS illegal, coalesce(e.best.c, 0) AS cost, coalesce(e.best.w, '') AS audit, sha256(coalesce(substr(e.best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op12_vector_codes": _codes_sql(),
}
