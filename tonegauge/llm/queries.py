"""Registered queries of the training-data operators: the columns each contract asks for."""

from pyspark.sql import functions as F

from tonegauge.llm import (
    conversations, decontamination, huffman, language_model, ngram_join, packing, passages, pii, quality,
    spelling, toxicity, vector_search, warc,
)
from tonegauge.llm.common import scratch, table
from tonegauge.plans.registry import query

_WORDS = ("list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")

OP1_SQL = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
gram AS (SELECT DISTINCT item, gram FROM (
  SELECT item, unnest(CASE WHEN len(w) < 10 THEN [w]
    ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS gram FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
length AS (SELECT DISTINCT len(gram) AS n FROM gram),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, length WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, p, n, item FROM place JOIN gram ON w[p:p + n - 1] = gram.gram),
word AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op1_decontamination", OP1_SQL)
def op1(spark, sf):
    """Rows of documents with equal id and text get equal results; a null text has no words."""
    found = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op2_quality_rules")
def op2(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.fit(docs))
    return judged.select(
        "row.doc_id", "x.n_words", "x.word_chars", "x.n_symbols", "x.n_dup_lines", "x.n_repeat_words",
        "base_failed", "kept", F.round("quality", 6).alias("quality"))


@query("op3_lm_scoring")
def op3(spark, sf):
    return language_model.score(table(spark, sf, "documents"))


@query("op4_substring_dedup")
def op4(spark, sf):
    return passages.repeated_passages(table(spark, sf, "documents"))


@query("op5_token_files")
def op5(spark, sf):
    path = scratch(spark, "token-files")
    huffman.write_tokens(table(spark, sf, "documents"), path)
    return huffman.read_tokens(spark, path)


@query("op6_pii")
def op6(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", pii.find_spans(docs).alias("found"))
    counts = [F.size(F.filter("found", pii.of_kind(kind))).cast("long").alias(f"n_{kind}")
              for kind in ("email", "ip", "card", "phone")]
    return rows.select(
        "doc_id", *counts,
        F.sha2(pii.digest_text(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.digest_text(F.col("found")).alias("spans"))


@query("op7_packing")
def op7(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@query("op8_toxicity")
def op8(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


OP9_SQL = """
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
  THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM doc),
size AS (SELECT doc_id, count(s) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingle x JOIN shingle y
  ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
edge AS (SELECT a, b FROM pair JOIN size m ON a = m.doc_id JOIN size n ON b = n.doc_id
  WHERE 100 * shared >= 75 * (m.n + n.n - shared)),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""


@query("op9_ngram_jaccard", OP9_SQL)
def op9(spark, sf):
    return ngram_join.link(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


OP10_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
kept AS (SELECT body, max(page_id) AS winner, count(*) AS n FROM page WHERE strlen(body) >= 1000 GROUP BY body)
SELECT page_id, strlen(p.body)::BIGINT AS payload_bytes, sha1(p.body) AS payload_digest,
  CASE WHEN n > 1 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND page_id <> winner THEN winner END AS refers_to
FROM page p LEFT JOIN kept k ON p.body = k.body"""


@query("op10_warc", OP10_SQL)
def op10(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"))


OP11_SQL = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
valid AS (SELECT vec_id, x FROM whole WHERE vec_id IS NOT NULL AND x IS NOT NULL
  AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
usual AS (SELECT len(x) AS n FROM valid GROUP BY n ORDER BY count(*) DESC, n DESC LIMIT 1),
vec AS (SELECT row_number() OVER () AS row, vec_id, list_transform(x, lambda c: floor(c * 256)) AS v
  FROM valid JOIN usual ON len(x) = n),
scored AS (SELECT q.row AS row, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vec q JOIN vec c ON q.row <> c.row WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""


@query("op11_vector_search", OP11_SQL)
def op11(spark, sf):
    """The five highest integer inner products of every fiftieth vector with all others."""
    return vector_search.top_k(table(spark, sf, "embeddings"), k=5, every=50)


# CRC-32 of the bytes in column ``b``, by its table of 256 remainders in ``crc_table``.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])))"""


def _bytes(text: str) -> str:
    """SQL for the UTF-8 bytes of a string as numbers."""
    digit = "strpos('123456789ABCDEF', hex(encode({0}))[{1}])"
    high, low = digit.format(text, "2 * i - 1"), digit.format(text, "2 * i")
    return f"list_transform(range(1, strlen({text}) + 1), lambda i: 16 * {high} + {low})"


OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
run AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents),
low AS (SELECT concat(doc_id, ':') AS id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
  count(*) AS n FROM run GROUP BY ALL),
byte AS (SELECT w, n, {_bytes('(id || w)')} AS b FROM low WHERE length(w) >= 6),
hashed AS (SELECT w, n, {_CRC} AS h FROM byte, crc_table),
word AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gap AS (SELECT word, n, i, word[1:i - 1] AS head, word[i + 1:] AS tail
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (SELECT x.word AS a, x.n AS an, y.word AS b, y.n AS bn FROM gap x JOIN gap y
    ON x.i = y.i AND x.head = y.head AND x.tail = y.tail AND x.word < y.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gap g JOIN word w ON w.word = g.head || g.tail),
side AS (SELECT a AS word, b AS other, bn AS other_n FROM pair UNION SELECT b, a, an FROM pair),
near AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, form := other)) AS best FROM side GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN best.form END AS form,
  CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n FROM word LEFT JOIN near USING (word)),
step(word, place) AS (SELECT word, word FROM formed
  UNION ALL SELECT s.word, f.form FROM step s JOIN formed f ON s.place = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.place AS root, f.n, f.n_near, f.form_n FROM formed f JOIN step s USING (word)
  JOIN formed l ON l.word = s.place WHERE l.form IS NULL"""


@query("op13_spelling_groups", OP13_SQL)
def op13(spark, sf):
    """Words of all documents with their near words' number, the form they vary and its root."""
    return spelling.group_spellings(table(spark, sf, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


# Edits of a row by state (nothing, s, u, a): the least (cost, audit, text) that reaches each state, row by row.
def _option(state: int, letter: str, cost: str, body: str) -> str:
    take = f"struct_pack(cost := best[{state}].cost + {cost}, audit := best[{state}].audit || '{letter}', body := best[{state}].body || {body})"
    return f"CASE WHEN best[{state}] IS NULL THEN [] ELSE [{take}] END"


def _when(test: str, options: str) -> str:
    return f"CASE WHEN {test} THEN {options} ELSE [] END"


def _least(*options: str) -> str:
    """The least of lists of options, by cost and then audit; null if there are none."""
    return f"list_sort({' || '.join(options)})[1]"


def _closed(best: str) -> str:
    """Adds insertions; two in a row never pay to come back."""
    user = lambda b, s: f"CASE WHEN {b}[{s}] IS NULL THEN [] ELSE [struct_pack(cost := {b}[{s}].cost + 3, audit := {b}[{s}].audit || 'I', body := {b}[{s}].body || ['user:'])] END"
    both = lambda b, s: f"CASE WHEN {b}[{s}] IS NULL THEN [] ELSE [struct_pack(cost := {b}[{s}].cost + 6, audit := {b}[{s}].audit || 'II', body := {b}[{s}].body || ['user:', 'assistant:'])] END"
    last = lambda b, s: f"CASE WHEN {b}[{s}] IS NULL THEN [] ELSE [struct_pack(cost := {b}[{s}].cost + 3, audit := {b}[{s}].audit || 'I', body := {b}[{s}].body || ['assistant:'])] END"
    own = lambda b, s: f"CASE WHEN {b}[{s}] IS NULL THEN [] ELSE [{b}[{s}]] END"
    return (f"[{best}[1], {best}[2], {_least(own(best, 3), user(best, 1), user(best, 2), user(best, 4))}, "
            f"{_least(own(best, 4), both(best, 1), both(best, 2), last(best, 3))}]")


def _row_step() -> str:
    kept, added = "fault NOT IN ('blank', 'duplicate')", "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    keep = lambda state, role: _when(f"{kept} AND role[1:1] = '{role}'", _option(state, "K", added, "[role || ':' || text]"))
    rerole = lambda state, name: _when(kept, _option(state, "R", f"{added} + 3", f"['{name}:' || text]"))
    drop = lambda state: _option(state, "D", "4", "[]::VARCHAR[]")
    to_user = [x for state in (1, 2, 4) for x in (keep(state, "u"), rerole(state, "user"))]
    return (f"[{drop(1)}[1], {_least(drop(2), keep(1, 's'))}, {_least(drop(3), *to_user)}, "
            f"{_least(drop(4), keep(3, 'a'), rerole(3, 'assistant'))}]")


OP12_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
part AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
byte AS (SELECT * EXCLUDE (place), {_bytes('place')} AS b FROM part),
hashed AS (SELECT conv_id, turn, role, text, {_CRC} % 20 AS h FROM byte, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN ''
  WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM hashed, range(CASE h WHEN 3 THEN 2 ELSE 1 END)
  WHERE h <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM numbered),
faulty AS (SELECT conv_id, turn, role, text, i, CASE WHEN body = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
  WHEN body[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS meets FROM placed),
conv AS (SELECT DISTINCT conv_id FROM conversations),
counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (meets IS NOT NULL AND meets NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
step(conv_id, i, best) AS (
  SELECT conv_id, 0::BIGINT, [struct_pack(cost := 0, audit := '', body := []::VARCHAR[]), NULL, NULL, NULL] FROM conv
  UNION ALL SELECT conv_id, i, {_row_step()} FROM (
    SELECT s.conv_id, f.i, f.role, f.text, f.fault, {_closed('s.best')} AS best
    FROM step s JOIN faulty f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1)),
last AS (SELECT conv_id, {_closed('best')} AS best, i FROM step),
done AS (SELECT l.conv_id, gaps, blank, duplicate, truncated, illegal,
  list_sort(CASE WHEN best[1] IS NULL THEN [best[4]] WHEN best[4] IS NULL THEN [best[1]] ELSE [best[1], best[4]] END)[1] AS r
  FROM last l LEFT JOIN counted c ON l.conv_id IS NOT DISTINCT FROM c.conv_id WHERE l.i = coalesce(n, 0))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, r.cost::BIGINT AS cost, r.audit AS audit,
  sha256(array_to_string(r.body, chr(10))) AS repaired_sha256 FROM done"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark, sf):
    """Faults of every damaged conversation, its cheapest repair and a digest of the repaired rows."""
    return conversations.damage_and_repair(table(spark, sf, "conversations"))
