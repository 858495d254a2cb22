"""The operators on the given tables, and SQL that returns the same rows where it can be written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality
from .bpe import round_trip
from .collocations import collocations, phrase_counts
from .html_extract import extract_pages
from .langid import identify
from .licenses import scan_licenses
from .mixing import mix_plan
from .neardup import near_duplicates
from .packing import pack_documents, word_count
from .tokens import count_tokens
from .topk import top_k
from .url_filter import SiteRule, judge_urls, path_of
from .variants import letter_runs, variant_groups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

SITE_RULES = (
    SiteRule("block", "net", "/"),
    SiteRule("allow", "example.net", "/en/"),
    SiteRule("block", "example.com", "/de/"),
    SiteRule("allow", "org", "/fr/"),
)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of pages whose document (the number at the end of the path) is labelled toxic."""
    number = F.try_to_number(F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.html|/)?$", 1), F.lit("9" * 18)).cast("bigint")
    pages = table(spark, sf_dir, "pages").select("url", number.alias("doc_id"))
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    return pages.join(toxic, "doc_id", "left_semi").select("url")


CANONICAL_SQL = r"""
raw AS (
  SELECT page_id, url,
    CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN NULL ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
cut AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS query
  FROM raw),
canon AS (
  SELECT page_id, host, path,
    array_to_string(list_sort(list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS q,
    regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '^(www|m)\.', '') AS h,
    regexp_replace(path, '(/index)?\.html?$|/+$', '') AS p
  FROM cut),
keyed AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN h || p || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical,
    TRY_CAST(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.html|/)?$', 1), '') AS BIGINT) AS number
  FROM canon)
"""


@query(
    f"""
WITH {CANONICAL_SQL},
listed AS (SELECT DISTINCT canonical FROM keyed
  WHERE canonical IS NOT NULL AND number IN (SELECT doc_id FROM labels WHERE toxic = 1)),
fits AS (
  SELECT *, canonical IS NOT NULL AND canonical IN (SELECT canonical FROM listed) AS listed,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM keyed)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical, listed
FROM fits"""
)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), listed_urls(spark, sf_dir), SITE_RULES)


_VALUES = {
    "symbols": "CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END",
    "dup_lines": "CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END",
    "repeats": "CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END",
    "word_length": "CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END",
}
_LIMITS = [*[f"hi_{k}" for k in quality.REACH], *[f"lo_{k}" for k in quality.LOW_TOO]]


def _value(b: str) -> str:
    """SQL of the largest value of a bucket."""
    return f"(({b} % 64 + 1) << ({b} // 64)) - 1"


QUALITY_SQL = rf"""
w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
pos AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c FROM pos),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
v AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        {', '.join(f'{x} AS v_{k}' for k, x in _VALUES.items())} FROM m),
b AS ({' UNION ALL '.join(f"SELECT lang, source, '{k}' AS name, v_{k} AS x FROM v WHERE NOT base_failed" for k in _VALUES)}),
h AS (SELECT lang, source, name, greatest(length(bin(x)) - 6, 0) AS s, x FROM b),
g AS (SELECT lang, source, name, s * 64 + (x >> s) AS b FROM h),
levels AS (SELECT 0 AS level, * FROM g UNION ALL SELECT 1, lang, NULL, name, b FROM g UNION ALL SELECT 2, NULL, NULL, name, b FROM g),
cum AS (SELECT level, lang, source, name, b, count(*) OVER (PARTITION BY level, lang, source, name ORDER BY b) AS c,
        count(*) OVER (PARTITION BY level, lang, source, name) AS docs FROM levels),
q AS (SELECT level, lang, source, name, max(docs) AS docs, {', '.join(f'min(CASE WHEN 100 * c >= {x} * docs THEN b END) AS b{x}' for x in quality.QUANTILES)}
      FROM cum GROUP BY ALL),
qv AS (SELECT *, {', '.join(f'{_value(f"b{x}")} AS q{x}' for x in quality.QUANTILES)} FROM q),
lim AS (SELECT level, lang, source, max(docs) AS docs,
  {', '.join(f"max(CASE WHEN name = '{k}' AND docs >= {quality.TAIL_DOCS if hi > 95 else 0} THEN {_value(f'(b{hi} + 1)')} + {t} * (q{hi} - q{lo}) // {o} END) AS hi_{k}" for k, (lo, hi, t, o) in quality.REACH.items())},
  {', '.join(f"max(CASE WHEN name = '{k}' THEN {_value(f'greatest(b{100 - quality.REACH[k][1]} - 1, 0)')} - {quality.REACH[k][2]} * (q{quality.REACH[k][0]} - q{100 - quality.REACH[k][1]}) // {quality.REACH[k][3]} END) AS lo_{k}" for k in quality.LOW_TOO)}
  FROM qv GROUP BY ALL),
pick AS (
  SELECT v.*, coalesce(a.level, l.level, t.level) AS level, a.level AS has_a, l.level AS has_l,
    {', '.join(f'CASE WHEN a.level IS NOT NULL THEN a.{x} WHEN l.level IS NOT NULL THEN l.{x} ELSE t.{x} END AS {x}' for x in _LIMITS)}
  FROM v LEFT JOIN lim a ON a.level = 0 AND a.docs >= {quality.MIN_DOCS} AND a.lang IS NOT DISTINCT FROM v.lang AND a.source IS NOT DISTINCT FROM v.source
  LEFT JOIN lim l ON l.level = 1 AND l.docs >= {quality.MIN_DOCS} AND l.lang IS NOT DISTINCT FROM v.lang
  LEFT JOIN lim t ON t.level = 2)
"""
KEPT_SQL = "NOT base_failed AND " + " AND ".join(
    f"coalesce(v_{k} <= hi_{k}, true)" + (f" AND coalesce(v_{k} >= lo_{k}, true)" if k in quality.LOW_TOO else "") for k in quality.REACH
)


@query(
    f"""WITH {QUALITY_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {KEPT_SQL} AS kept, n_lines, lang, source FROM pick"""
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_count(F.col("text")))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query(
    """
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 100 = 0 AND q.id <> c.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
)
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


@query(
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b, c = x.n AND c = y.n AS same FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
g AS (SELECT x, min(y) AS component FROM r GROUP BY x),
e AS (SELECT a, least(a, min(b)) AS class FROM l WHERE same GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
  coalesce(component, d.doc_id) = d.doc_id AS kept, coalesce(class, d.doc_id) AS class_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN g ON d.doc_id = g.x LEFT JOIN e ON d.doc_id = e.a"""
)
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query()
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query(
    """
WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS i,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS w FROM documents),
told AS (SELECT w, hex(encode(i || ':' || w)) AS x FROM runs WHERE length(w) >= 5),
crc AS (SELECT w, xor(4294967295, list_reduce(list_transform(range(1, length(x), 2), lambda k: CAST('0x' || substr(x, k, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h FROM told, tab),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM crc),
v AS (SELECT word, count(*) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
gap AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut, substr(word, 1, i) || '_' || substr(word, i + 2) AS pattern
  FROM v, LATERAL (SELECT unnest(range(length(word))) AS i)),
fewer AS (SELECT DISTINCT gap.word AS a, v.word AS b FROM gap JOIN v ON gap.cut = v.word),
near AS (SELECT x.word AS a, y.word AS b FROM gap x JOIN gap y ON x.pattern = y.pattern AND x.word <> y.word
  UNION ALL SELECT a, b FROM fewer UNION ALL SELECT b, a FROM fewer),
ranked AS (SELECT a, b, n AS form_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS r
  FROM near JOIN v ON near.b = v.word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN b END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM v LEFT JOIN ranked ON a = word AND r = 1),
up AS (SELECT word, word AS root, form FROM formed UNION ALL SELECT up.word, f.word, f.form FROM up JOIN formed f ON up.form = f.word)
SELECT f.word, n, n_near, f.form, form_n, root FROM formed f JOIN up ON f.word = up.word WHERE up.form IS NULL"""
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(letter_runs(table(spark, sf_dir, "documents")).filter("n >= 3"))


@query(
    r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT c.lang, c.phrase, c.k, a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM c, LATERAL (SELECT unnest(range(1, k)) AS j)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:j], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cuts),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS around
  FROM c, LATERAL (SELECT unnest(range(2, k)) AS m), LATERAL (SELECT unnest(range(1, k - m + 2)) AS i) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase WHERE o = 1 AND (around IS NULL OR 100 * around < 80 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked r JOIN total t ON r.lang = t.lang WHERE rank <= 2000"""
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(phrase_counts(table(spark, sf_dir, "documents")))
