"""SQL of the queries that SQL can express; the others are tested against brute-force versions."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"

# A mix takes the rows of a source in order of hash and size until the next one would pass the budget;
# that one is taken too if more than half of it fits. Shares of capped sources go to the others round
# by round.
SOURCE_MIX = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce({WORDS.format("text")}, 0) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 9))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, size AS source_size, 2.0 * size AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS size FROM docs GROUP BY source)
), rounds AS (
  SELECT 0 AS n, source, source_size, most, weight, false AS capped,
    1.5 * (SELECT sum(source_size) FROM sources) * weight / (SELECT sum(weight) FROM sources) AS share
  FROM sources
  UNION ALL
  SELECT n + 1, source, source_size, most, weight, full_now,
    (1.5 * sum(source_size) OVER () - coalesce(sum(most) FILTER (full_now) OVER (), 0)) * weight
      / nullif(sum(weight) FILTER (NOT full_now) OVER (), 0)
  FROM (SELECT *, capped OR share >= most AS full_now FROM rounds) WHERE n < 40
), targets AS (
  SELECT source, source_size, round(CASE WHEN capped OR share >= most THEN most ELSE share END, 6) AS target
  FROM rounds WHERE n = 40
), plan AS (
  SELECT *, floor(target / greatest(source_size, 1)) AS times FROM targets
), placed AS (
  SELECT d.*, p.source_size, p.target, p.times, p.target - p.times * p.source_size AS due,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.size, doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (size * (times + CASE WHEN before + size <= due OR (before <= due AND 2 * (due - before) > size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


# URL models: every order keeps contexts seen four times or more, and the longest kept one counts.
def _url_model(order: int) -> str:
    context = f"substr(gram, {5 - order}, {order})" if order else "''"
    if order:
        kept = "WHERE yes + no >= 4"
        lower = f"(SELECT {{0}} FROM model{order - 1} m WHERE m.context = substr(f.context, 2) AND m.symbol = f.symbol)"
    else:
        kept, lower = "", "1.0 / 42"
    return f"""
cells{order} AS (
  SELECT {context} AS context, substr(gram, 5, 1) AS symbol, sum(CASE label WHEN 1 THEN n ELSE 0 END)::DOUBLE AS yes,
    sum(CASE label WHEN 0 THEN n ELSE 0 END)::DOUBLE AS no
  FROM counted GROUP BY 1, 2
), kept{order} AS (
  SELECT * FROM (SELECT context, sum(yes) AS yes, sum(no) AS no FROM cells{order} GROUP BY 1) {kept}
), model{order} AS (
  SELECT f.context, f.symbol, (coalesce(c.yes, 0) + 4 * {lower.format("p_yes")}) / (f.yes + 4) AS p_yes,
    (coalesce(c.no, 0) + 4 * {lower.format("p_no")}) / (f.no + 4) AS p_no
  FROM (SELECT k.*, unnest(string_split('abcdefghijklmnopqrstuvwxyz0123456789./-_~$', '')) AS symbol FROM kept{order} k) f
  LEFT JOIN cells{order} c ON c.context = f.context AND c.symbol = f.symbol
),"""


_URL_JOINS = "".join(
    f" LEFT JOIN model{k} m{k} ON m{k}.symbol = substr(gram, 5, 1) AND m{k}.context = "
    + (f"substr(gram, {5 - k}, {k})" if k else "''")
    for k in range(5)
)
_URL_RATIO = "coalesce(" + ", ".join(f"ln(m{k}.p_yes / m{k}.p_no)" for k in reversed(range(5))) + ", 0)"
URL_VERDICTS = rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rests
), named AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule,
    regexp_replace(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^a-z0-9./_-]', '~', 'g') AS text
  FROM parts
), ruled AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM named
), texts AS (
  SELECT text, CASE ruled WHEN 'allow' THEN 1 WHEN 'block' THEN 0 END AS label, count(*) AS n,
    ('0x' || substr(md5(text), 1, 8))::BIGINT % 5 = 0 AS held
  FROM ruled GROUP BY ALL
), counted AS (
  SELECT label, gram, sum(n) AS n FROM (
    SELECT label, n, substr('^^^^' || text || '$', unnest(range(1, length(text) + 2)), 5) AS gram
    FROM texts WHERE label IS NOT NULL AND NOT held) GROUP BY 1, 2
), {"".join(map(_url_model, range(5)))}
grams AS (
  SELECT text, substr('^^^^' || text || '$', unnest(range(1, length(text) + 2)), 5) AS gram FROM (SELECT DISTINCT text FROM texts)
), scores AS (
  SELECT text, CASE text WHEN '' THEN 0.0 ELSE round(sum(round({_URL_RATIO}, 9)) / count(*), 6) END AS score
  FROM grams {_URL_JOINS} GROUP BY text
), steps AS (
  SELECT floor(score * 100) AS step, sum(n) AS n FROM texts JOIN scores USING (text) WHERE held AND label = 1 GROUP BY 1
), bound AS (
  SELECT coalesce(min(step) FILTER (upto > 0.01 * every), max(step), 0) / 100 AS bound FROM (
    SELECT step, sum(n) OVER (ORDER BY step) AS upto, sum(n) OVER () AS every FROM steps)
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= bound THEN 'allow' ELSE 'block' END) AS verdict, score
FROM ruled JOIN scores USING (text), bound
"""


# Quality cutoffs: chances of so few rejections or fewer are summed from logarithms of factorials.
QUALITY_RULES = r"""
WITH words AS (
  SELECT doc_id, coalesce('=' || lang, '') AS lang, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 4] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS pos
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS seen FROM windows) WHERE seen > 1)
  GROUP BY 1
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words
), base AS (
  SELECT w.doc_id, lang, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(w, lambda x: strlen(x) = 1)) AS n_short
  FROM words w JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id)
), steps AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    lang AS stratum,
    least(ceil(n_symbols * 100 / greatest(word_chars, 1)), 100) AS s1, least(ceil(n_dup_lines * 100 / greatest(n_lines, 1)), 100) AS s2,
    least(ceil(n_repeat_words * 100 / greatest(n_words, 1)), 100) AS s3, least(ceil(n_short * 100 / greatest(n_words, 1)), 100) AS s4
  FROM base
), known AS (
  SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1
), tested AS (
  SELECT stratum, good, unnest([1, 2, 3, 4]) AS rule, unnest([s1, s2, s3, s4]) AS step FROM steps JOIN known USING (doc_id)
  WHERE NOT base_failed
), counts AS (
  SELECT stratum, rule, step, sum(good::INT) AS good, sum((NOT good)::INT) AS bad FROM tested GROUP BY ALL
), summed AS (
  SELECT *, sum(good) OVER p AS n, sum(bad) OVER p AS n_bad, sum(good) OVER d AS good_above, sum(bad) OVER d AS bad_above
  FROM counts WINDOW p AS (PARTITION BY stratum, rule), d AS (PARTITION BY stratum, rule ORDER BY step DESC)
), held AS (
  SELECT *, round(bad_above::DOUBLE / greatest(n_bad, 1) - 10 * good_above::DOUBLE / greatest(n, 1), 9) AS gain FROM summed
  WHERE step > 0 AND good_above < 0.005 * n
    AND list_sum(list_transform(range(0, good_above::BIGINT + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
      + k * ln(0.005) + (n - k) * ln(0.995)))) <= 0.05 / (4 * (SELECT count(DISTINCT stratum) FROM counts))
), cuts AS (
  SELECT stratum, rule, max(step) - 1 AS cut
  FROM (SELECT *, max(gain) OVER (PARTITION BY stratum, rule) AS most FROM held) WHERE gain = most AND gain > 0 GROUP BY 1, 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM cuts c WHERE c.stratum = s.stratum
    AND CASE rule WHEN 1 THEN s1 WHEN 2 THEN s2 WHEN 3 THEN s3 ELSE s4 END > cut) AS kept
FROM steps s
"""


# Near-duplicates by distinct two-word shingles: pairs are counted shingle by shingle.
SET_SIMILARITY = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.other FROM reached r JOIN (SELECT a AS here, b AS other FROM links UNION ALL SELECT b, a FROM links) l
    ON l.here = r.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) USING (doc_id)
"""


# Ranked search: whole numbers but for the logarithm of a weight.
RANKED_SEARCH = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), total AS (
  SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_words FROM docs
), postings AS (
  SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id,
    sum(w * q * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words))))::BIGINT AS score
  FROM (SELECT item_id, term, count(*) AS q FROM items GROUP BY ALL) JOIN postings USING (term) JOIN weights USING (term), total
  GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": QUALITY_RULES,
        "op4_source_mix": SOURCE_MIX,
        "op8_url_verdicts": URL_VERDICTS,
        "op11_set_similarity": SET_SIMILARITY,
        "op13_ranked_search": RANKED_SEARCH,
    }
