"""The registered queries of the numbered operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatspark.llm import decontamination, fingerprints, language_model, lexical_search, line_dedup, mixing, near_dedup, quality_classifier, quality_rules, substring_dedup, token_alignment, toxicity, url_filter
from threatspark.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@query("op5_line_dedup", r"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line FROM documents,
        unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS lead FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, c.lead IS NOT NULL AND c.lead <> k.doc_id AS dropped FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over all documents: line counts and the hash of what stays."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.line_digest(docs, line_dedup.keep_bitmaps(docs))


def _op9_sql() -> str:
    """Brute force: every window as a list of words, joined to its count."""
    w = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM documents),
x AS (SELECT doc_id, i, length(w[i]) AS c FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
n AS (SELECT doc_id, count(*) AS n_words, sum(c) AS word_chars FROM x GROUP BY doc_id),
g AS (SELECT k, doc_id, i, count(*) OVER (PARTITION BY k, doc_id, g) AS copies FROM (
  SELECT k, doc_id, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM d, (SELECT unnest([5, 6, 7, 8, 9, 10]) AS k),
    unnest(range(1, len(w) - k + 2)) AS u(i))),
e AS (SELECT DISTINCT k, doc_id, i + j AS i FROM g, unnest(range(0, k)) AS v(j) WHERE copies > 1),
r AS (SELECT doc_id, count(*) FILTER (k = 5) AS n_repeat_words, """
    w += ", ".join(f"coalesce(sum(c) FILTER (k = {n}), 0) AS c{n}" for n in quality_rules.MAX_NGRAM_PERCENT)
    w += r""" FROM e JOIN x USING (doc_id, i) GROUP BY doc_id),
l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line FROM documents,
  unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)),
p AS (SELECT doc_id, length(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), '')) AS c,
  row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth FROM l),
q AS (SELECT doc_id, count(*) AS n_word_lines, count(*) FILTER (nth > 1) AS n_dup_lines,
  coalesce(sum(c) FILTER (nth > 1), 0) AS dup_chars FROM p WHERE c > 0 GROUP BY doc_id),
a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  100 * coalesce(dup_chars, 0) > """ + str(quality_rules.MAX_LINE_CHAR_PERCENT) + " * coalesce(word_chars, 0) OR 100 * coalesce(n_dup_lines, 0) > " + str(quality_rules.MAX_LINE_PERCENT) + " * coalesce(n_word_lines, 0)"
    w += "".join(f" OR 100 * coalesce(c{n}, 0) > {p} * coalesce(word_chars, 0)" for n, p in quality_rules.MAX_NGRAM_PERCENT.items())
    w += r""" AS bad FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN q USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT bad AS kept FROM b"""
    return w


@query("op9_quality_rules", _op9_sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition coverage of all documents and its verdict."""
    judged = quality_rules.judge(quality_rules.repetition(table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op10_sql() -> str:
    rules = ", ".join(f"('{r}', '{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in url_filter.RULES)
    names = ", ".join(f"('{x}')" for x in url_filter.BLOCKED_HOSTS)
    return rf"""WITH b(name) AS (VALUES {names}), r(rule, verdict, rh, rp) AS (VALUES {rules}),
u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p, r
  WHERE (host = rh OR host LIKE '%.' || rh) AND path LIKE rp || '%' GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN EXISTS (SELECT 1 FROM b WHERE p.host = name OR p.host LIKE '%.' || name) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f USING (page_id)"""


@query("op10_url_filter", _op10_sql())
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then the block list by cascade, over all pages."""
    listed = spark.sql("SELECT explode(array(" + ", ".join(f"'{x}'" for x in url_filter.BLOCKED_HOSTS) + ")) AS key")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), listed)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.graded(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "grade", (F.col("p_toxic") >= toxicity.REJECT_AT).alias("toxic"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document and the Gumbel top-k draw."""
    return quality_classifier.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op1_sql() -> str:
    """Plays the schedule slot by slot; `had` counts the blocks of the current phase."""
    share = "".join(f" WHEN '{k}' THEN {v}" for k, v in mixing.SHARES.items())
    return f"""WITH RECURSIVE k AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source
    ORDER BY ('0x' || substr(md5('{mixing.SEED}' || doc_id), 1, 15))::BIGINT, doc_id) - 1 AS n FROM documents),
s AS (SELECT source, CASE source{share} ELSE {mixing.DEFAULT_SHARE} END AS share, (max(n) // {mixing.BLOCK_DOCS}) + 1 AS blocks FROM k GROUP BY source),
a AS (SELECT list(source ORDER BY source) AS names, list(share ORDER BY source) AS shares, list(blocks ORDER BY source) AS blocks FROM s),
t(slot, rest, had, turn, phase, pick) AS (
  SELECT -1::BIGINT, blocks, [0::BIGINT for x in blocks], 0::BIGINT, 0, 0 FROM a
  UNION ALL
  SELECT slot + 1, rest2, CASE WHEN done THEN [0::BIGINT for x in rest2] ELSE had2 END, CASE WHEN done THEN 0 ELSE turn + 1 END,
    CASE WHEN done THEN phase + 1 ELSE phase END, p FROM (
    SELECT *, rest2[p] = 0 AS done FROM (
      SELECT slot, turn, phase, p, [rest[i] - (i = p)::BIGINT for i in range(1, len(rest) + 1)] AS rest2,
        [had[i] + (i = p)::BIGINT for i in range(1, len(rest) + 1)] AS had2 FROM (
        SELECT *, (list_min([CASE WHEN rest[i] > 0 AND (had[i] * q) // shares[i] <= turn
          THEN (((had[i] + 1) * q + shares[i] - 1) // shares[i]) * 100000 + i END for i in range(1, len(rest) + 1)]) % 100000)::BIGINT AS p FROM (
          SELECT t.*, shares, list_sum([CASE WHEN rest[i] > 0 THEN shares[i] ELSE 0 END for i in range(1, len(rest) + 1)])::BIGINT AS q
          FROM t, a WHERE list_max(rest) > 0))))),
v AS (SELECT names[pick] AS source, slot, lag(phase, 1, 0) OVER (ORDER BY slot) AS phase,
    row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS block FROM t, a WHERE pick > 0)
SELECT doc_id, k.source, v.block, v.phase, v.slot, (n % {mixing.BLOCK_DOCS})::INT AS seat
FROM k JOIN v ON v.source = k.source AND v.block = n // {mixing.BLOCK_DOCS}"""


@query("op1_source_mix", _op1_sql())
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query("op3_language_model")
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney scores of all documents, learnt from those not held out."""
    return language_model.score_held_out(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a passage of the item in the document."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_near_dedup", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id,
  least(w.doc_id, coalesce(low, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = w.doc_id""")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, similarity 0.85 or more."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op8_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM w, unnest(range(1, len(w) - 33)) AS u(i)),
r AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, unnest(range(0, 35)) AS v(j)),
x AS (SELECT doc_id, i, w[i] AS word FROM w, unnest(range(1, len(w) + 1)) AS u(i)),
k AS (SELECT x.doc_id, count(*) AS n_words, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL) AS kept
  FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY x.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and the hash of what repeated 35-word windows leave of every document."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between a byte-level and a piece tokenizer, over all documents."""
    aligned = token_alignment.align(table(spark, sf_dir, "documents"))
    return aligned.withColumn("groups_sha256", token_alignment.digest(F.col("groups"))).drop("groups")


@query("op12_lexical_search", rf"""
WITH k AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
a AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS terms FROM k),
m AS (SELECT doc_id, 10 + (90 * count(*) * any_value(docs)) // any_value(terms) AS m FROM k, a GROUP BY doc_id),
f AS (SELECT doc_id, term, count(*) AS tf FROM k GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, a GROUP BY term),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {lexical_search.TOP}""")
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item, out of all."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op13_sql() -> str:
    """Sets of digests compared as they are; the sketch cell by cell."""
    keys = lambda text: f"list_distinct(list_transform(regexp_extract_all({text}, '{fingerprints.PATTERN}'), lambda x: ('0x' || substr(md5(x), 1, 15))::BIGINT))"
    p, f = fingerprints._PRIMES, fingerprints._FACTORS
    cell = f"list_filter(KEYS, lambda x: (x >> (20 * (i // {fingerprints.CELLS}))) % {fingerprints.CELLS} = i % {fingerprints.CELLS})"
    check = f"list_transform(OWN, lambda x: ((x % {p[0]}) * {f[0]} + (x >> 31) * {f[1]}) % {p[1]})"
    xor = lambda x: f"coalesce(list_aggregate({x}, 'bit_xor'), 0)"
    text = lambda k: ("array_to_string(list_transform(range(" + str(fingerprints.SUB_TABLES * fingerprints.CELLS) + f"), lambda i: format('{{:x}}:{{:x}}:{{:x}}', len(OWN), {xor('OWN')}, "
                      + xor(check) + ")), ' ')").replace("OWN", cell).replace("KEYS", k)
    near = lambda b: f"CASE WHEN len(a) + len({b}) = 0 THEN 1.0::DOUBLE ELSE 2 * len(list_intersect(a, {b}))::DOUBLE / (len(a) + len({b})) END"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS u FROM d),
e AS (SELECT *, substring(t, 1, n - n // 2) || substring(u, 1, n // 2) AS v FROM o),
k AS (SELECT *, {keys('t')} AS a, {keys('v')} AS b, {keys('u')} AS c FROM e)
SELECT doc_id, n AS n_chars, sha256(v) AS edited_sha256, {text('a')} AS fingerprint, {text('b')} AS edited_fingerprint,
  {near('b')} AS near_edited, {near('c')} AS near_next FROM k"""


@query("op13_fingerprints", _op13_sql())
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and of their edited texts, and their likeness."""
    return fingerprints.compare(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
