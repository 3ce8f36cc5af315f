"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm import align, bytebpe, collocations, fingerprints, jaccardjoin, lines, neardup, packing, quality, repair, secrets, suffixes, tokens, urls
from saleswright.llm import text as T

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Host labels of the sites that ``op2_url_filter`` lists; fixed values.
LISTED_SITES = ("ads-track", "casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets")


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the fixed rules and by a list: the canonical URLs of all listed sites."""
    pages = table(spark, folder, "pages")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    listed = pages.where(F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, LISTED_SITES)))).select(
        urls.canonical(host, path).alias("key")
    )
    return urls.url_filter(pages, urls.rule_table(spark), listed)


_SITES = ", ".join(f"'{x}'" for x in LISTED_SITES)
SQL["op2_url_filter"] = rf"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(rule_host, rule_path, rule_verdict) AS (
  VALUES {", ".join(map(str, urls.RULES))}
), fit AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict, row_number() OVER (
    PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_verdict DESC) AS k
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), k AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS key FROM u
), listed AS (
  SELECT DISTINCT key FROM k WHERE list_has_any(string_split(host, '.'), [{_SITES}])
)
SELECT k.page_id, host, path, rule, listed.key IS NOT NULL AS listed,
  coalesce(rule_verdict, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM k LEFT JOIN fit ON fit.page_id = k.page_id AND fit.k = 1 LEFT JOIN listed ON listed.key = k.key
"""


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base figures and verdict of every document."""
    return quality.quality_table(table(spark, folder, "documents")).drop("clean_text")


@query
def op10_repair_output(spark: SparkSession, folder: str) -> DataFrame:
    """Written as Re-Pair shards, and read back."""
    docs = table(spark, folder, "documents")
    return repair.read_documents(repair.write_shards(docs, tokens.vocabulary_path(tokens.VOCABULARY)))


#: Target shares of two sources in each window of ``op3_packing``; the others split the rest by their size.
TARGETS = {"src0": 0.2, "src1": 0.1}


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 4096 tokens, each window to the target proportions as long as its sources last."""
    return packing.pack(table(spark, folder, "documents"), tokens.vocabulary_path(tokens.VOCABULARY), TARGETS)


@query
def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its component of near copies."""
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they and their neighbours are."""
    return fingerprints.edited(table(spark, folder, "documents"))


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    return secrets.spans_table(table(spark, folder, "documents"))


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again."""
    import public_tokenizers

    docs = table(spark, folder, "documents")
    return bytebpe.encode_decode(docs, public_tokenizers.path(bytebpe.RANKS), public_tokenizers.PATTERN)


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What later copies of line runs take from each document, and a digest of what stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.deduplicated(docs, report="report").select(
        "doc_id", "report.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def _later_runs(n: int) -> str:
    held = ", ".join(f"l{k}" for k in range(n))
    words = f"AND {' + '.join(f'w{k}' for k in range(n))} > {lines.MIN_WORDS}" if n < lines.MIN_LINES else ""
    return f"""SELECT doc_id, pos, {n} AS size FROM runs WHERE l{n - 1} IS NOT NULL {words}
  QUALIFY row_number() OVER (PARTITION BY {held} ORDER BY doc_id, pos) > 1"""


SQL["op1_line_dedup"] = rf"""
WITH every AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS idx
  FROM documents
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS pos
  FROM every WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM worded
), runs AS (
  SELECT doc_id, pos, {", ".join(f"lead(line, {k}) OVER w AS l{k}, lead(n, {k}) OVER w AS w{k}" for k in range(lines.MIN_LINES))}
  FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  {" UNION ALL ".join(_later_runs(n) for n in range(1, lines.MIN_LINES + 1))}
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM (SELECT doc_id, pos, unnest(range(size)) AS k FROM later)
), islands AS (
  SELECT doc_id, n, count(*) AS size FROM (
    SELECT doc_id, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM gone) GROUP BY doc_id, n
), runs_of AS (
  SELECT doc_id, sum(size)::BIGINT AS n_removed, count(*) AS n_runs, max(size) AS longest_run FROM islands GROUP BY doc_id
), kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.idx) AS text
  FROM every e LEFT JOIN worded w USING (doc_id, idx) LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = w.pos
  WHERE g.pos IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(w.n, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  coalesce(longest_run, 0) AS longest_run, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN runs_of r USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id) w USING (doc_id)
"""


QUERIES["op1_line_dedup_words"], SQL["op1_line_dedup_words"] = op1_line_dedup, SQL["op1_line_dedup"]  # its name when words were an option


@query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What repeated strings of 200 bytes take from each document."""
    return suffixes.without_repeats(table(spark, folder, "documents")).drop("spans")


_GAP = r"[\x20\x09-\x0D]"
SQL["op7_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), runs AS (
  SELECT doc_id, unnest(range(1, len(words) - {T.WIDTH - 2})) AS p, words FROM d WHERE len(words) >= {T.WIDTH}
), counted AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, words[p:p + {T.WIDTH - 1}]) AS n FROM runs
), repeated AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM counted, (SELECT unnest(range({T.WIDTH})) AS k) WHERE n > 1 GROUP BY doc_id
), every AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM d
), l AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS nth, length(regexp_replace(line, '{_GAP}', '', 'g')) AS chars,
    regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
  FROM every WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), s AS (
  SELECT *, length(regexp_replace(line, '[^|»›·•]', '', 'g')) + len(list_filter(words, lambda w: w IN ('/', '>'))) AS seps,
    len(list_filter(words, lambda w: regexp_matches(w, '(!!|\?\?)\.?$'))) AS shouted,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols
  FROM l
), f AS (
  SELECT doc_id, line, chars,
    (seps >= {quality.MIN_SEPARATORS} AND len(words) <= {quality.ITEM_WORDS + 1} * (seps + 1))
    OR regexp_matches(line, '{quality.BOILERPLATE}', 'i')
    OR (len(words) >= 2 AND shouted > {quality.MAX_SHOUTED} * len(words))
    OR symbols > {quality.MAX_SYMBOLS}::DOUBLE * length(line)
    OR (nth > 1 AND len(words) <= {quality.SHORT_LINE}
        AND NOT regexp_matches(line, '[.!?:;"''”’»…。！？)\]}}]{_GAP}*$')) AS fails
  FROM s
), g AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (fails) AS failed, sum(chars) FILTER (fails) AS lost
  FROM f GROUP BY doc_id
), b AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{_GAP}', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(failed, 0)::BIGINT AS n_failed_lines, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM d LEFT JOIN g USING (doc_id) LEFT JOIN repeated r USING (doc_id)
), v AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed FROM b
)
SELECT *, NOT base_failed AND lost_chars <= {quality.MAX_LOST}::DOUBLE * word_chars AS kept FROM v
"""

SQL["op8_minhash_near_dedup"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(2, len(words) - {T.WIDTH - 2})),
    lambda p: array_to_string(words[p:p + {T.WIDTH - 1}], ' ')))) AS shingles
  FROM d WHERE len(words) > 0
), c AS (
  SELECT shingles, min(doc_id) AS rep, len(shingles) AS n FROM s GROUP BY shingles
), e AS (
  SELECT rep, n, unnest(shingles) AS shingle FROM c
), linked AS (
  SELECT a.rep AS u, b.rep AS v FROM e a JOIN e b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {neardup.PERCENT} * (a.n + b.n - count(*))
), edges AS (
  SELECT u, v FROM linked UNION ALL SELECT v, u FROM linked
), reach AS (
  SELECT rep AS u, rep AS v FROM c UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u
), component AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT documents.doc_id, coalesce(len(s.shingles), 0)::BIGINT AS n_shingles,
  coalesce(component_id, documents.doc_id) AS component_id, coalesce(component_id, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN c USING (shingles) LEFT JOIN component ON component.u = c.rep
"""


@query
def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its component of documents that share four fifths of their shingles."""
    return jaccardjoin.joined(table(spark, folder, "documents"))


SQL["op11_ngram_join"] = SQL["op8_minhash_near_dedup"].replace(f">= {neardup.PERCENT} *", f">= {jaccardjoin.PERCENT} *").replace(
    ",\n  coalesce(component_id, documents.doc_id) AS component_id, coalesce(component_id, documents.doc_id) = documents.doc_id AS kept",
    ", coalesce(component_id, documents.doc_id) AS component_id",
)


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of each language that occur together more than their parts would by chance."""
    return collocations.collocations(table(spark, folder, "documents"))


_SIZES = range(1, collocations.LONGEST + 1)
SQL["op12_collocations"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), sized AS (
  SELECT lang, words, unnest(range(1, {collocations.LONGEST + 1})) AS size FROM w WHERE len(words) > 0
), runs AS (
  SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS p FROM sized WHERE len(words) >= size
), f AS (
  SELECT lang, size, words[p:p + size - 1] AS words, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}
), t AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
), cuts AS (
  SELECT f.lang, f.size, f.words, f.a, t.n, unnest(range(1, f.size)) AS k FROM f JOIN t USING (lang) WHERE f.size > 1
), scores AS (
  SELECT c.*, x.a AS l, y.a AS r, (1000::HUGEINT * c.a * c.n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.words = c.words[1:c.k] JOIN f y ON y.lang = c.lang AND y.words = c.words[c.k + 1:]
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, a, unnest(range(2, size)) AS m, words, size FROM f WHERE size > 2
), inside AS (
  SELECT lang, words[q:q + m - 1] AS words, max(a) AS longer FROM (
    SELECT lang, a, m, words, unnest(range(1, size - m + 2)) AS q FROM inner_) GROUP BY ALL
)
SELECT * FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.words, ' ')) AS rank,
    array_to_string(b.words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.words = b.words
  WHERE longer IS NULL OR 100 * longer < 100 * a
) WHERE rank <= {collocations.REPORTED}
"""


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens of two vocabularies in groups of the same bytes."""
    a, b = map(tokens.vocabulary_path, (align.A_VOCABULARY, align.B_VOCABULARY))
    return align.aligned(table(spark, folder, "documents"), a, b)
