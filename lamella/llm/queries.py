"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm import (chunked_bpe, collision_ann, filter_audit, fm_quality, importance, language, line_rules, orc_tokens, packing, piece_agenda,
                         pii, quote_links, simhash)
from lamella.llm.common import fold
from lamella.plans.catalog import Query, Tables
from lamella.session import scratch_dir

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(tables)`` under its own name, apart from the library's own queries."""
    def register(fn):
        def run(spark, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return register


@query("""
WITH RECURSIVE m AS (
  SELECT row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, coalesce(text, '')) - 1 AS id,
         conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
cut AS (SELECT id, conv_id, string_split(text, chr(10)) AS parts FROM m),
each AS (SELECT id, conv_id, i AS pos, parts[i] AS line FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM cut)),
marked AS (SELECT *, regexp_extract(line, '^((?:[ \\t]*>)*)', 1) AS marks FROM each),
leveled AS (SELECT *, length(marks) - length(replace(marks, '>', '')) AS level FROM marked),
said AS (SELECT *, CASE WHEN level > 0 THEN substr(line, length(marks) + 1) ELSE line END AS words FROM leveled),
plained AS (SELECT *, trim(regexp_replace(lower(words), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS plain FROM said),
announced AS (SELECT *, coalesce(regexp_matches(words, '^[ \\t]*On\\b.*\\bwrote:[ \\t\\r]*$')
                AND lead(level) OVER (PARTITION BY id ORDER BY pos) > level, false) AS announces,
              lag(level) OVER (PARTITION BY id ORDER BY pos) AS above FROM plained),
lines AS (SELECT *, sum(CASE WHEN above IS DISTINCT FROM level OR plain = '' OR announces THEN 1 ELSE 0 END)
                    OVER (PARTITION BY id ORDER BY pos) AS passage FROM announced),
used AS (SELECT * FROM lines WHERE plain <> '' AND NOT announces),
pieces AS (SELECT id, conv_id, level, passage, string_agg(plain, ' ' ORDER BY pos) AS plain FROM used GROUP BY ALL
           UNION SELECT id, conv_id, level, passage, plain FROM used),
originals AS (SELECT conv_id, plain, min(id) AS source FROM pieces WHERE level = 0 GROUP BY ALL),
found AS (SELECT q.*, CASE WHEN o.source < q.id THEN o.source END AS source FROM pieces q LEFT JOIN originals o
          ON q.plain = o.plain AND q.conv_id IS NOT DISTINCT FROM o.conv_id WHERE level > 0),
counts AS (SELECT id, count(*) AS n_quoted, count(*) FILTER (n > 0) AS n_linked
           FROM (SELECT id, passage, count(source) AS n FROM found GROUP BY ALL) GROUP BY id),
best AS (SELECT id, source FROM (SELECT id, level, source, sum(length(plain)) AS size FROM found WHERE source IS NOT NULL GROUP BY ALL)
         QUALIFY row_number() OVER (PARTITION BY id ORDER BY level, size DESC, source DESC) = 1),
tree AS (SELECT m.*, coalesce(source, lag(m.id) OVER (PARTITION BY conv_id ORDER BY m.id)) AS parent FROM m LEFT JOIN best USING (id)),
walk AS (SELECT id, [id] AS path FROM tree WHERE parent IS NULL
         UNION ALL SELECT t.id, list_append(w.path, t.id) FROM walk w JOIN tree t ON t.parent = w.id),
bodies AS (SELECT id, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines WHERE level = 0 AND NOT announces GROUP BY id)
SELECT t.conv_id, t.turn, t.role, row_number() OVER (PARTITION BY t.conv_id ORDER BY path) - 1 AS position,
       CAST(len(path) - 1 AS BIGINT) AS depth, p.turn AS reply_to, coalesce(n_quoted, 0) AS n_quoted,
       coalesce(n_linked, 0) AS n_linked, coalesce(body, '') AS body
FROM tree t JOIN walk USING (id) LEFT JOIN tree p ON p.id = t.parent LEFT JOIN counts c ON c.id = t.id
LEFT JOIN bodies b ON b.id = t.id
""")
def op1_quote_links(t: Tables) -> DataFrame:
    return quote_links.conversations(t.conversations)


@query()
def op2_collision_counting(t: Tables) -> DataFrame:
    return collision_ann.search(t.embeddings, F.col("vec_id") % 20 == 0)


@query()
def op3_chunked_bpe(t: Tables) -> DataFrame:
    return chunked_bpe.encode(t.documents).drop("ids")


@query()
def op4_factorisation_machine(t: Tables) -> DataFrame:
    machine = fm_quality.fit(t.documents, t.labels, fold("doc_id", 3) != 1)
    scored = fm_quality.with_score(t.documents.select("doc_id", "text", "n_chars"), machine)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op5_pattern_packing(t: Tables) -> DataFrame:
    return packing.pack_documents(t.documents)


@query()
def op6_pii_anchors(t: Tables) -> DataFrame:
    found = pii.find_spans(t.documents.select("doc_id", "text"))
    counts = [F.size(pii.of_kinds(F.col("spans"), kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.listed(pii.of_kinds(F.col("spans"), *pii.BASE)), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


@query()
def op7_orc_tokens(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "orc-tokens")
    orc_tokens.write(t.documents, path)
    return orc_tokens.located(t.spark, path)


@query()
def op8_simhash_blocks(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents)


@query()
def op9_ftrl_language(t: Tables) -> DataFrame:
    model = language.fit(t.documents, fold("doc_id", 4) != 2)
    return language.identify(t.documents, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS body FROM documents),
w AS (SELECT doc_id, body, list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM d),
grams AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS g
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM again, unnest(range(0, 5)) AS t(o) GROUP BY doc_id),
lines AS (SELECT doc_id, source, body, unnest(string_split(body, chr(10))) AS line FROM d),
used AS (SELECT *, trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS plain,
                length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS size FROM lines),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM used WHERE plain <> '' GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT body) AS n FROM d GROUP BY source),
frequent AS (SELECT u.source, plain FROM used u JOIN hosts h ON u.source IS NOT DISTINCT FROM h.source WHERE plain <> ''
             GROUP BY u.source, plain, h.n HAVING count(DISTINCT body) > 3 AND (count(DISTINCT body) > 0.02 * h.n OR count(DISTINCT body) > 1000)),
gone AS (SELECT doc_id, sum(size) AS lost FROM used u JOIN frequent f
         ON u.plain = f.plain AND u.source IS NOT DISTINCT FROM f.source GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM w),
joined AS (SELECT b.*, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
           FROM base b LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost < 0.8 * word_chars AS kept FROM judged
""")
def op10_line_frequency(t: Tables) -> DataFrame:
    return line_rules.judge(t.documents.select("doc_id", "text", "source"), with_rest=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM d),
firsts AS (SELECT body, min(doc_id) AS least FROM d GROUP BY body),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
told AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS fails
         FROM w JOIN firsts USING (body) LEFT JOIN l ON l.doc_id = w.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM told GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
met AS (SELECT *, CASE WHEN instr(fails, o[1]) > 0 THEN 1 WHEN instr(fails, o[2]) > 0 THEN 2 WHEN instr(fails, o[3]) > 0 THEN 3
                       WHEN instr(fails, o[4]) > 0 THEN 4 WHEN instr(fails, o[5]) > 0 THEN 5 ELSE 6 END AS hit FROM cells, orders),
each AS (SELECT part, o AS filter_order, step, o[step] AS own, coalesce(sum(n) FILTER (hit > step), 0) AS kept,
                coalesce(sum(n) FILTER (hit = step), 0) AS removed, coalesce(sum(n) FILTER (hit < step AND instr(fails, o[step]) > 0), 0) AS redundant,
                coalesce(sum(n) FILTER (fails = o[step]), 0) AS unique_fails, coalesce(sum(good) FILTER (hit = step), 0) AS good_lost,
                coalesce(sum(toxic) FILTER (hit = step), 0) AS toxic_lost
         FROM met, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) GROUP BY part, o, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM each
""")
def op11_filter_audit(t: Tables) -> DataFrame:
    return filter_audit.audit(t.documents, t.labels)


@query()
def op12_piece_agenda(t: Tables) -> DataFrame:
    decimals = F.array_join(F.col("ids").cast("array<string>"), " ")
    return piece_agenda.encode(t.documents).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")


@query("""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
cut AS (SELECT 'd' AS of, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
words AS (SELECT of, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM cut),
used AS (SELECT of, doc_id, unnest(w) AS w FROM words),
spelled AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM used)),
hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda j: CAST('0x' || substr(x, 2 * j + 1, 2) AS BIGINT))),
                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256)), 4294967295) % 10000 AS bucket FROM spelled, crc),
counted AS (SELECT bucket, CAST(count(*) FILTER (of = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (of = 'b') AS DOUBLE) AS t
            FROM used JOIN hashed USING (w) GROUP BY bucket),
gained AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counted) + 10000)
                          / ((s + 1) * ((SELECT sum(t) FROM counted) + 10000)))) AS BIGINT) AS gain FROM counted),
weighed AS (SELECT doc_id, sum(gain) AS weight FROM used JOIN hashed USING (w) JOIN gained USING (bucket) WHERE of = 'd' GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)
                       + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
           FROM words LEFT JOIN weighed USING (doc_id) WHERE of = 'd'),
ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
                  count(*) FILTER (n_features >= 20) OVER () AS enough FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * enough // 100 THEN place END AS rank FROM ranked
""")
def op13_prefix_crc(t: Tables) -> DataFrame:
    return importance.resample(t.documents, t.benchmark).select("doc_id", "n_features", "weight", "score", "rank")
