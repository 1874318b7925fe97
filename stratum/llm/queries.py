"""The queries over the given tables, one per operator, with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import brown, chat, decontaminate, divergence, forest, langid, lexical, licenses, packing, periodic, simhash, substring, warc
from stratum.llm.tables import crc_of_id, given, small_batches


HELD_OUT_FOLD, HELD_OUT_FOLDS = 1, 5


def op1_brown_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", crc_of_id() % HELD_OUT_FOLDS == HELD_OUT_FOLD)
    model, counts = brown.train(docs.where(~F.col("held_out")))
    return brown.scores(docs, model, counts)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(given(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(given(spark, sf_dir, "documents"), with_ids=False)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"),
        "contaminated")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_substrings(given(spark, sf_dir, "documents").select("doc_id", "text"), joined=True)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = given(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    keys = pages.select(warc.url_key(F.col("url")).alias("url_key"), "page_id")
    return warc.read_records(archive, warc.lookup(spark, archive, keys)).drop("payload")


def op7_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(given(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


LANGUAGE_FOLD, LANGUAGE_FOLDS = 2, 4


def learned_languages(docs: DataFrame) -> langid.Model | None:
    """Models of the languages of all documents that are not held out."""
    return langid.train(docs.where(crc_of_id() % LANGUAGE_FOLDS != LANGUAGE_FOLD))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    held_out = (crc_of_id() % LANGUAGE_FOLDS == LANGUAGE_FOLD).alias("held_out")
    found = langid.predictions(docs.select("doc_id", "text"), learned_languages(docs))
    return found.select("row.*", "lang_pred", "score", "bits", "rejected").select(
        "doc_id", held_out, "lang_pred", "score", "bits", "rejected")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(given(spark, sf_dir, "conversations"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(given(spark, sf_dir, "documents"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


def op12_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.divergence(given(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in one document of ten (by crc32 of the id) the words from one on repeat with a period."""
    crc = crc_of_id()
    g = F.floor(crc / 10)

    def rebuilt(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, at(i))), " ")

    own = F.transform(F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)), rebuilt)
    chosen = (crc % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(chosen, F.element_at(own, 1)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(made_periodic(given(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    found = found.withColumn("first", longest)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("first.col2")).alias("start"), F.col("first.length").alias("length"), (-F.col("first.col3")).alias("period"),
        F.expr("1000 * first.length div -first.col3").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_brown_lm_scoring, op2_license_scan, op3_best_fit_packing, op4_benchmark_decontamination, op5_substring_dedup,
    op6_warc_index, op7_random_projection_forest, op8_language_id, op9_chat_formatting, op10_simhash_near_dedup,
    op11_ranked_lexical_search, op12_distribution_divergence, op13_periodic_runs,
)}

# op2: all windows of the grid against all templates, by shared shingles. MinHash misses a match of the least allowed
# similarity once in a million times.
_OP2 = r"""
WITH templates(license, text) AS (VALUES {templates}),
tokens AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
shingles AS (SELECT doc_id, text, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, text, w, unnest(range(1, greatest(1, len(w) - 3))) AS i FROM tokens)),
wanted AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT license, w, unnest(range(1, greatest(1, len(w) - 3))) AS i
        FROM (SELECT license, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM templates))),
sized AS (SELECT license, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS top FROM wanted GROUP BY 1),
classes AS (SELECT license, n, greatest(1, top // 4) AS stride, top + greatest(1, top // 4) - 1 AS length FROM sized),
hits AS (SELECT doc_id, text, license, s, pos, n, stride, length FROM shingles JOIN wanted USING (s) JOIN classes USING (license)),
windows AS (SELECT doc_id, text, license, n, length, stride * unnest(range(
    CASE WHEN pos >= length THEN (pos - length + stride) // stride ELSE 0 END,
    pos // stride + 1)) AS a, s FROM hits),
shared AS (SELECT doc_id, text, license, n, length, a, count(DISTINCT s) AS k FROM windows GROUP BY ALL)
SELECT doc_id, license, max(k) / n AS containment, arg_max(a, k * 10000000000 - a) AS first_word, CAST(length + 4 AS INTEGER) AS n_words
FROM shared WHERE k / n >= 0.8 GROUP BY doc_id, text, license, n, length
"""

# op4: every window of an item, every run of as many words of a document. Words are numbered, so that a document word
# is hit if it lies in a run that equals a window.
_OP4 = r"""
WITH tokens AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS run, least(13, len(w)) AS size
  FROM (SELECT id AS item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM tokens WHERE kind = 'b' AND len(w) > 0)),
runs AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS run
  FROM (SELECT id AS doc_id, w, size, unnest(range(1, greatest(1, len(w) - size + 2))) AS i
        FROM tokens, (SELECT DISTINCT size FROM windows) WHERE kind = 'd')),
found AS (SELECT doc_id, item_id, i, r.size FROM runs r JOIN windows USING (size, run)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM tokens LEFT JOIN words ON id = words.doc_id LEFT JOIN items ON id = items.doc_id WHERE kind = 'd'
"""

_OP5 = r"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 33))) AS i FROM tokens),
windows AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS run FROM starts),
twice AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows SEMI JOIN twice USING (run)),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM tokens LEFT JOIN lost USING (doc_id)
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {' + '.join(f'{16 >> k} * CAST(substr(bits, {5 * i + k + 1}, 1) AS INTEGER)' for k in range(5))}, 1)"
    for i in range(32))

_OP6 = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages),
latest AS (SELECT bits, max(page_id) AS original FROM payloads GROUP BY bits)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM payloads JOIN latest USING (bits)
"""

# op9: a conversation as a list of turns; it goes if the list is the beginning of a longer one.
_OP9 = """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
logs AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS LAST, role, text) AS log FROM turns GROUP BY conv_id),
copies AS (SELECT min(conv_id) AS conv_id, log FROM logs GROUP BY log),
parts AS (SELECT DISTINCT log[1:k] AS log FROM (SELECT log, unnest(range(1, len(log))) AS k FROM logs))
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(len(log) AS BIGINT) AS n_turns, array_to_string(list_transform(log, lambda x:
  '<|im_start|>' || replace(x.r, '<|', '< |') || chr(10) || replace(x.t, '<|', '< |') || '<|im_end|>' || chr(10)), '') AS text
FROM copies ANTI JOIN parts USING (log)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# op11: every term of every item in every document.
_OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, t, CAST(len(t) AS BIGINT) AS n
  FROM (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents)),
terms AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs WHERE n > 0),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM terms GROUP BY term), total),
wanted AS (SELECT q, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS q, item_id,
  regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM benchmark)),
scores AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN terms USING (term) JOIN weights USING (term) JOIN docs USING (r), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""


def _jsd(counts: str, shares: str) -> str:
    """Jensen-Shannon distance of a list of counts and one of shares."""
    p = f"(x[1] / list_sum({counts}))"
    part = f"CASE WHEN {{v}} > 0 THEN {{v}} * log2(2 * {{v}} / ({p} + x[2])) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({counts}, {shares}), lambda x: ({part.format(v=p)} + {part.format(v='x[2]')}) / 2))))"


_CLASS_SIZES = ", ".join(f"len(text) - len(regexp_replace(text, '[{body}]+', '', 'g')) AS {name}" for name, body in (
    ("lower", "a-z"), *((n, b.replace("'", "''")) for n, b in divergence.CLASSES.items())))
_CLASS_BINS = f"[{', '.join(['lower', *divergence.CLASSES])}, len(text) - lower - {' - '.join(divergence.CLASSES)}]"

# op12: the references from all documents, then the distances of each. All given documents have a language of enough words.
_OP12 = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
tokens AS (SELECT r, doc_id, lang, text, CAST(len(w) AS BIGINT) AS n_words, w, {_CLASS_BINS} AS bins, spaces, symbols
  FROM (SELECT *, regexp_extract_all(text, '{divergence.WORD}') AS w, {_CLASS_SIZES} FROM texts)),
windows AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 3))) AS i FROM tokens)),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p
  FROM windows JOIN (SELECT r, s FROM windows GROUP BY ALL HAVING count(*) > 1) USING (r, s)) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{divergence.WORD}') GROUP BY r),
each AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM tokens WHERE lang IS NOT NULL) GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY lang ORDER BY n DESC RANGE UNBOUNDED PRECEDING) AS place, sum(n) OVER (PARTITION BY lang) AS total FROM each)
  WHERE place <= {divergence.COMMON}),
common AS (SELECT lang, list(word ORDER BY n, word) AS words, list(n / total ORDER BY n, word) || [1 - sum(n) / any_value(total)] AS shares FROM top GROUP BY lang),
classes AS (SELECT lang, list(n / total ORDER BY c) AS classes FROM (SELECT lang, c, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total
  FROM (SELECT lang, unnest(bins) AS n, unnest(range(len(bins))) AS c FROM tokens) GROUP BY lang, c) GROUP BY lang),
counts AS (SELECT r, lang, list_transform(words, lambda x: len(list_filter(w, lambda y: y = x))) AS n FROM tokens JOIN common USING (lang)),
far AS (SELECT r, (len(text) >= {divergence.MIN_CHARS} AND {_jsd('bins', 'classes')} > {divergence.MAX_CLASS_DISTANCE}) OR (n_words >= {divergence.MIN_COMMON}
    AND {_jsd('(n || [n_words - list_sum(n)])', 'shares')} > {divergence.MAX_WORD_DISTANCE}) AS far
  FROM tokens JOIN counts USING (r) JOIN common ON common.lang = tokens.lang JOIN classes ON classes.lang = tokens.lang WHERE n_words > 0),
judged AS (SELECT tokens.*, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_dup_lines, coalesce(far, false) AS far
  FROM tokens LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r) LEFT JOIN far USING (r))
SELECT doc_id, n_words, CAST(len(text) - spaces AS BIGINT) AS word_chars, CAST(symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT far AS kept FROM judged
"""

# op13: a run's first period equals its second, so some six words in a row are found again one period on. crc32 bit by bit.
_OP13 = r"""
WITH ids AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
    lambda c: CASE WHEN c = '' THEN [] ELSE [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] END))) AS steps FROM documents),
hashed AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(4294967295, list_reduce(steps, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
    WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS h FROM ids),
places AS (SELECT r, doc_id, w, n, h % 10 = 0 AND n > 0 AS made, CASE WHEN n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS part FROM hashed),
tokens AS (SELECT r, doc_id, n, CASE WHEN made THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // part) END]) ELSE w END AS w FROM places),
sixes AS (SELECT r, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT r, w, unnest(range(0, greatest(0, n - 5))) AS i FROM tokens WHERE n >= 12)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS lag FROM sixes x JOIN sixes y ON x.r = y.r AND x.s = y.s AND x.i < y.i),
islands AS (SELECT r, lag, min(i) AS start, count(*) + 5 + lag AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM pairs) GROUP BY r, lag, island),
runs AS (SELECT r, start, length, min(lag) AS period FROM islands WHERE length >= greatest(12, 2 * lag) GROUP BY ALL),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM tokens) ANTI JOIN dropped USING (r, i) GROUP BY r),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list,
  arg_min({'start': start, 'length': length, 'period': period}, [-length, start, period]) AS longest FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
  (1000 * longest.length) // longest.period AS exponent_milli,
  sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM tokens LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": _OP2.format(templates=", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in licenses.TEMPLATES.items())),
    "op6_warc_index": _OP6, "op9_chat_formatting": _OP9,
    "op4_benchmark_decontamination": _OP4, "op5_substring_dedup": _OP5, "op11_ranked_lexical_search": _OP11,
    "op12_distribution_divergence": _OP12, "op13_periodic_runs": _OP13}
