"""Queries of this package's operators over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabula.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    language_id,
    near_dedup,
    quality_cotrain,
    quality_rules,
    repeated_passages,
    secret_scan,
    signature_search,
    token_counts,
    token_shards,
    whitening,
)
from tabula.llm.common import read, saved, workspace


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_quality_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_cotrain.classify(docs, quality_cotrain.train(docs, read(spark, sf_dir, "labels")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = token_counts.length_histogram(token_counts.encoded_lengths(read(spark, sf_dir, "documents")))
    # the sums read the histogram more than once, so the documents are encoded into it first
    return token_counts.suffix_sums(saved(hist, workspace(spark, "op4-histogram")))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "op5-shards")
    token_shards.write_shards(read(spark, sf_dir, "documents"), out)
    return token_shards.digests(spark, out)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(read(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents")).drop("text_md5")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.report(read(spark, sf_dir, "conversations"))


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.report(read(spark, sf_dir, "documents"))


def op12_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_quality_cotrain, op3_quality_rules, op4_token_counts, op5_token_shards, op6_secret_scan,
    op7_byte_bpe, op8_language_id, op9_near_dedup, op10_chat_format,
    op11_repeated_passages, op12_signature_search, op13_whitening,
)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') g FROM
  (SELECT item, w, least(len(w), 10) n, unnest(range(1, len(w) - least(len(w), 10) + 2)) i FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') g FROM
  (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) p FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item, n, p FROM places JOIN windows USING (n, g)),
hit_words AS (SELECT doc_id, count(DISTINCT q) n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) q FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_FENCE_COLUMNS = ", ".join(
    f"quantile_disc({n}, {tail}) t_{n}, quantile_disc({n}, 0.5) m_{n}, quantile_disc({n}, {1 - tail}) b_{n}"
    for n, (tail, *_) in quality_rules.FENCES.items()
)


def _fence(name: str) -> str:
    _, reach, margin, both = quality_rules.FENCES[name]

    def pick(q: str) -> str:
        least = quality_rules.MIN_DOCS
        return f"(CASE WHEN own.n >= {least} THEN own.{q}_{name} WHEN wide.n >= {least} THEN wide.{q}_{name} ELSE whole.{q}_{name} END)"

    top, middle, bottom = pick("t"), pick("m"), pick("b")
    high = f"{name} <= {top} + greatest({reach} * ({top} - {middle}), {margin}::DOUBLE)"
    low = f" AND {name} >= {bottom} - greatest({reach} * ({middle} - {bottom}), {margin}::DOUBLE)"
    return high + (low if both else "")


OP3_SQL = rf"""
WITH words AS (SELECT doc_id, lang, source, coalesce(text, '') t, {_WORDS.format("coalesce(text, '')")} w FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM words)),
repeats AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest(range(i, i + 3)) p FROM
  (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) c FROM grams) WHERE c > 1) GROUP BY doc_id),
counted AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) n_words,
  CAST(list_sum(list_transform(list_append(w, ''), lambda x: length(x))) AS BIGINT) word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) n_symbols,
  CAST(len(regexp_extract_all(t, '[!?]')) AS BIGINT) n_marks,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines,
  CAST(coalesce(n, 0) AS BIGINT) n_repeat_words FROM words LEFT JOIN repeats USING (doc_id)),
rated AS (SELECT doc_id, lang, source, n_words, word_chars, n_symbols, n_repeat_words,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) n_dup_lines,
  n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words base_failed,
  n_symbols / greatest(word_chars, 1) symbol_ratio, (len(lines) - len(list_distinct(lines))) / greatest(len(lines), 1) dup_line_ratio,
  n_repeat_words / greatest(n_words, 1) repeat_ratio, n_marks / greatest(n_words, 1) mark_ratio, word_chars / greatest(n_words, 1) mean_word
  FROM counted),
passed AS (SELECT * FROM rated WHERE NOT base_failed),
own AS (SELECT lang, source, count(*) n, {_FENCE_COLUMNS} FROM passed GROUP BY lang, source),
wide AS (SELECT lang, count(*) n, {_FENCE_COLUMNS} FROM passed GROUP BY lang),
whole AS (SELECT count(*) n, {_FENCE_COLUMNS} FROM passed)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({" AND ".join(_fence(n) for n in quality_rules.FENCES)}, TRUE) kept
FROM rated LEFT JOIN own ON rated.lang IS NOT DISTINCT FROM own.lang AND rated.source IS NOT DISTINCT FROM own.source
LEFT JOIN wide ON rated.lang IS NOT DISTINCT FROM wide.lang CROSS JOIN whole
"""

OP9_SQL = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') g FROM
  (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) n FROM sets GROUP BY doc_id),
links AS (SELECT a.doc_id a, b.doc_id b FROM sets a JOIN sets b USING (g) JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.root FROM reach r JOIN links l ON l.b = r.node),
roots AS (SELECT node, min(root) root FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) n_shingles, root component_id, d.doc_id = root kept
FROM documents d JOIN roots ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

OP10_SQL = f"""
WITH said AS (SELECT conv_id, turn, regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '[\\r\\n]+', ' ', 'g') speaker,
    replace(coalesce(text, ''), '<|', '< |') said FROM conversations),
turns AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said) - 1) // {chat_format.BLOCK_TURNS} block FROM said),
people AS (SELECT DISTINCT conv_id, speaker perspective FROM turns WHERE speaker <> 'system'),
parts AS (SELECT t.conv_id, perspective, block, turn, speaker, said, speaker = perspective own,
    '{chat_format.OPEN}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user name=' || speaker END || chr(10) head
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
whole AS (SELECT *, head || said || '{chat_format.CLOSE}' || chr(10) a FROM parts),
placed AS (SELECT *, sum(length(a)) OVER (PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, speaker, said ROWS UNBOUNDED PRECEDING) - length(a) pos FROM whole),
blocks AS (SELECT conv_id, perspective, block, count(*) n_turns, string_agg(a, '' ORDER BY turn NULLS FIRST, speaker, said) rendered,
    coalesce(string_agg((pos + length(head))::BIGINT || ':' || (pos + length(a) - 1)::BIGINT, ',' ORDER BY pos) FILTER (own), '') mask
  FROM placed GROUP BY conv_id, perspective, block)
SELECT conv_id, perspective, block, CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY block NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) block_start, n_turns, rendered, mask FROM blocks
"""

OP11_SQL = rf"""
WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {repeated_passages.WINDOW - 1}], ' ') g FROM
  (SELECT doc_id, w, unnest(range(1, len(w) - {repeated_passages.WINDOW - 2})) i FROM words WHERE len(w) >= {repeated_passages.WINDOW})),
led AS (SELECT g, min(doc_id) lo FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, list_sort(list_distinct(flatten(list(range(i, i + {repeated_passages.WINDOW}))))) r FROM windows JOIN led USING (g) WHERE doc_id > lo GROUP BY doc_id),
places AS (SELECT doc_id, unnest(w) x, unnest(range(1, len(w) + 1)) i FROM words),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) t FROM places p ANTI JOIN (SELECT doc_id, unnest(r) i FROM gone) USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(len(r), 0) AS BIGINT) n_removed, sha256(coalesce(t, '')) kept_sha256
FROM words LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12_SQL = rf"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t FROM documents),
tf AS (SELECT doc_id, t, count(*) f FROM words GROUP BY doc_id, t),
lengths AS (SELECT doc_id, CAST(sum(f) AS BIGINT) n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) c, CAST(sum(n) AS BIGINT) l FROM lengths),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(c) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) w FROM tf, totals GROUP BY t),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t FROM benchmark),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * f) // (1000 * f + 8 * (10 + (90 * n * c) // l)))) AS BIGINT) score
  FROM items JOIN tf USING (t) JOIN weights USING (t) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {signature_search.TOP}
"""

ORACLES = {
    "op1_decontaminate": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op9_near_dedup": OP9_SQL,
    "op10_chat_format": OP10_SQL,
    "op11_repeated_passages": OP11_SQL,
    "op12_signature_search": OP12_SQL,
}
