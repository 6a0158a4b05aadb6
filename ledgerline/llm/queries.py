"""The registered queries of the subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import lm_score, suffix_dedup, toxicity
from .decontaminate import find_items
from .licenses import BASE_PHRASES, BASE_SCORE, TEMPLATE_SCORE, TEMPLATES, parse, scan_licenses
from .ngram_join import linked_rows, ngram_join
from .packing import pack
from .phrases import phrase_digest
from .quality import RULES, SYMBOLS, quality_rules
from .resample import resample
from .shards import shard_digest
from .turn_trie import conversation_trie
from .warc import PERIOD, records_of_pages, resolve_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quality_sql() -> str:
    from .quality import STOP_WORDS
    def breaks(r) -> str:
        sides = " OR ".join(f"{r.feature} {op} {b}" for op, b in (("<", r.low), (">", r.high)) if b is not None)
        return f"({sides})" + (f" AND n_words >= {r.min_words}" if r.min_words else "")

    broken = " OR ".join(f"({breaks(r)})" for r in RULES)
    names = ", ".join(f"CASE WHEN {breaks(r)} THEN '{r.name}' END" for r in RULES)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
  list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM dup, (SELECT unnest(generate_series(0, 4)) AS k) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(words) AS n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(list_filter(words, lambda x: lower(rtrim(x, '.,;:!?')) IN ({stop}))) AS n_stop,
  len(list_filter(words, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 1)) AS n_upper,
  len(lines) AS n_lines FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
r AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
  n_stop / greatest(n_words, 1) AS stop_word_ratio,
  n_upper / greatest(n_words, 1) AS upper_ratio,
  n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR {broken}) AS kept,
  concat_ws(',', {names}) AS failed_rules FROM r"""


@query("op1_quality_rules", _quality_sql())
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of ``documents``."""
    return quality_rules(table(spark, sf_dir, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles_sql(table_name: str, key: str, short: bool) -> str:
    """(key, g): distinct 5-word shingles; with ``short``, fewer words make one shingle."""
    words = (f"list_filter(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), "
             "lambda x: x <> '')")
    last = "greatest(len(words) - 4, 1)" if short else "len(words) - 4"
    return (f"SELECT DISTINCT {key}, array_to_string(words[i:i + 4], ' ') AS g FROM ("
            f"SELECT {key}, words, unnest(generate_series(1, {last})) AS i FROM ("
            f"SELECT {key}, {words} AS words FROM {table_name} WHERE text IS NOT NULL) WHERE len(words) > 0)")


OP2_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({_shingles_sql('documents', 'doc_id', True)}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)"""

OP3_SQL = f"""
WITH s AS ({_shingles_sql('documents', 'doc_id', False)}),
i AS ({_shingles_sql('benchmark', 'item_id', False)}),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(n) AS item_shingles
FROM s JOIN i USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)"""


@query("op2_ngram_jaccard_join", OP2_SQL)
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by 80 % of their 5-word shingles."""
    return ngram_join(table(spark, sf_dir, "documents"))


@query("op2_ngram_jaccard_links")
def op2_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classes, with the number of links of each document."""
    return linked_rows(table(spark, sf_dir, "documents"))


@query("op3_benchmark_decontamination", OP3_SQL)
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` that a whole text of ``documents`` holds."""
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learned from the training part of ``labels``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, toxicity.held_out_rows())
    return toxicity.score(docs, model)


def _template_regex(template: str) -> str:
    """The template over words that each have one space before and after."""
    out = ""
    for kind, *rest in parse(template):
        if kind == "word":
            out += f" {rest[0]} "
        elif kind == "optional":
            out += "(?:" + "".join(f" {w} " for w in rest[0]) + ")?"
        else:
            out += f"(?: [^ ]+ ){{{rest[0]},{rest[1]}}}"
    return out


def _license_sql() -> str:
    base = []
    for phrase, label in BASE_PHRASES.items():
        words = phrase.split()
        test = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(words, 1))
        base.append((label, test))
    places = ", ".join(f"list_filter(idx, lambda i: ({test})) AS p{k}" for k, (_, test) in enumerate(base))
    every = "list_concat(" + ", ".join(f"p{k}" for k in range(len(base))) + ")"
    base_labels = "[" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{x}' END" for k, (x, _) in enumerate(base)) + "]"
    own = "[" + ", ".join(f"CASE WHEN regexp_matches(spaced, '{_template_regex(t)}') THEN '{x}' END"
                          for x, t in TEMPLATES) + "]"
    joined = lambda c: (
        f"coalesce(array_to_string(list_sort(list_distinct(list_filter({c}, lambda x: x IS NOT NULL))), ','), '')")
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(
    regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS words FROM documents),
a AS (SELECT doc_id, words, generate_series(0, len(words) - 1) AS idx,
  array_to_string(list_transform(words, lambda x: ' ' || x || ' '), '') AS spaced FROM w),
p AS (SELECT doc_id, len(words) AS n_words, spaced, {places} FROM a),
l AS (SELECT doc_id, n_words, {every} AS places, {base_labels} AS base, {own} AS own FROM p)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  {joined('base')} AS base_labels, {joined('list_concat(base, own)')} AS labels,
  CASE WHEN len(list_filter(own, lambda x: x IS NOT NULL)) > 0 THEN {TEMPLATE_SCORE}::DOUBLE
       WHEN len(places) > 0 THEN {BASE_SCORE}::DOUBLE ELSE 0::DOUBLE END AS score
FROM l"""


@query("op5_license_scan", _license_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text of ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


OP6_SQL = rf"""
WITH b AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, regexp_replace(regexp_replace(trim(url), '#.*$', ''),
    '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM pages),
c AS (SELECT page_id, digest,
  regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
  regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\??(.*)$', 1), '&'), lambda p:
    p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)='))) AS params FROM b),
p AS (SELECT page_id, digest, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&')
    ELSE '' END AS key, CASE WHEN page_id % 7 <> 3 THEN '"' || digest[1:16] || '"' END AS tag,
  'day ' || (page_id % 1000) AS day, page_id * {PERIOD} AS captured,
  page_id * {PERIOD} + CAST('0x' || md5(CAST(page_id AS VARCHAR))[1:4] AS BIGINT) AS again FROM c),
v AS (SELECT r.page_id * 2 + 1 AS revisit_id, r.key, r.again AS ts, f.page_id * 2 AS response_id,
    f.captured AS response_ts, f.digest, f.tag AS old_tag, f.day AS old_day, r.day,
    CASE WHEN r.page_id % 5 = 2 THEN '"changed"' ELSE 'W/' || r.tag END AS tag
  FROM p r LEFT JOIN p f ON f.key = r.key AND f.captured < r.again
  QUALIFY row_number() OVER (PARTITION BY r.page_id ORDER BY f.captured DESC NULLS LAST, f.page_id DESC NULLS LAST) = 1),
j AS (SELECT *, CASE WHEN response_id IS NULL THEN 'orphan'
  WHEN tag IS NOT NULL THEN CASE WHEN coalesce(replace(tag, 'W/', '') = old_tag, FALSE) THEN 'resolved' ELSE 'mismatch' END
  WHEN day = old_day THEN 'resolved' ELSE 'mismatch' END AS status FROM v)
SELECT revisit_id, key AS canonical_url, ts, status, response_id, response_ts,
  CASE WHEN status = 'resolved' THEN digest END AS payload_digest,
  CASE WHEN status = 'resolved' THEN concat_ws(chr(10), 'content-type: text/html', 'date: ' || ts,
    'etag: ' || coalesce(tag, old_tag), 'last-modified: ' || old_day) END AS merged_headers
FROM j"""


@query("op6_warc_revisits", OP6_SQL)
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of a crawl made of all ``pages``, resolved to earlier full captures."""
    return resolve_revisits(records_of_pages(table(spark, sf_dir, "pages")))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` that repeat 50-byte strings of earlier documents."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op8_token_shards")
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of ``documents`` as read back from the shards in training order."""
    return shard_digest(table(spark, sf_dir, "documents"))


@query("op9_lm_score")
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every whole text of ``documents`` by a model of the training part."""
    return lm_score.score(table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))


def _crc32_sql(text: str, steps: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``steps`` is a list of what each byte makes of the sum."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({text}))), "
            f"lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))), "
            f"lambda c, b: xor({steps}[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)), 4294967295)")


CRC32_STEPS = ("(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, "
               "list_transform(range(8), lambda x: 0::BIGINT)), "
               "lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)")


def _features_sql(words: str) -> str:
    return (f"SELECT r, unnest(list_concat(words, list_transform(range(1, greatest(len(words), 1)), "
            f"lambda i: words[i] || ' ' || words[i + 1]))) AS f FROM {words}")


_LOWER_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
                r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP12_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_LOWER_WORDS} AS words FROM documents),
t AS MATERIALIZED (SELECT row_number() OVER () AS r, {_LOWER_WORDS} AS words FROM benchmark),
df AS MATERIALIZED ({_features_sql('d')}), tf AS MATERIALIZED ({_features_sql('t')}),
crc AS MATERIALIZED (SELECT f, {_crc32_sql('f', 'steps')} % 10000 AS b
  FROM (SELECT f FROM df UNION SELECT f FROM tf), {CRC32_STEPS}),
s AS (SELECT b, count(*) AS s FROM df JOIN crc USING (f) GROUP BY b),
u AS (SELECT b, count(*) AS t FROM tf JOIN crc USING (f) GROUP BY b),
n AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS bs, (SELECT count(*) FROM tf)::DOUBLE AS bt),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * (bs + 10000) / ((s + 1) * (bt + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN u USING (b), n),
w AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM df JOIN crc USING (f) JOIN g USING (b) GROUP BY r),
c AS (SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8] AS BIGINT)
    + 0.5) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN w USING (r)),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place,
  count(*) OVER (PARTITION BY n_words >= 20) AS total FROM c)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= total * 25 // 100 THEN place END AS rank FROM k"""


@query("op12_target_resampling", OP12_SQL)
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed and drawn by how much they look like ``benchmark``."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = f"""
WITH t AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, turn, octet_length(encode(text)) AS size,
  sha256(octet_length(encode(role)) || ':' || role || text)[1:32] AS id FROM t),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id, size) AS k FROM i),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32_sql('conv_id::VARCHAR', 'steps')} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t), {CRC32_STEPS}),
b AS (SELECT c.conv_id, 0 AS part, o.k, o.id, o.size FROM c JOIN o ON o.conv_id = c.base WHERE o.k <= h
  UNION ALL SELECT c.conv_id, 1, o.k, o.id, o.size FROM c JOIN o USING (conv_id) WHERE o.k > h),
p AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS depth, size, string_agg(id || size, ',') OVER w AS path FROM b
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, k) UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS MATERIALIZED (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
  depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS MATERIALIZED (SELECT path, any_value(depth) AS depth, any_value(above) AS above, any_value(size) AS size,
  min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM q GROUP BY path),
k AS (SELECT above AS path, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
m AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
s AS (SELECT p.path, count(*) FILTER (m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.size)::BIGINT AS saved_tokens
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.path)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN s USING (path) LEFT JOIN n u ON u.path = m.above"""


@query("op11_conversation_trie", OP11_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all ``conversations``, rebuilt with shared heads."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_phrase_dedup")
def op13_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` that repeat 50-word windows of earlier documents."""
    return phrase_digest(table(spark, sf_dir, "documents"))
