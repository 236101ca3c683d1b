"""DuckDB SQL for the text queries that SQL can express."""

LINE_DEDUP = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM split
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, s.first IS NOT NULL AND s.first <> k.doc_id AS gone
  FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

MIX_SOURCES = r"""
WITH sized AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS documents,
    CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS words,
    (CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER earlier, 0) AS DOUBLE))
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS level
  FROM sources
  WINDOW earlier AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size, documents, words,
    CAST(floor(CAST(words AS DOUBLE) / 8 + 0.5) AS BIGINT) AS seats,
    CASE WHEN source_size * 3 <= level * weight THEN source_size * 3.0
      ELSE max(CASE WHEN source_size * 3 <= level * weight THEN NULL ELSE level END) OVER () * weight
    END::DOUBLE AS target
  FROM levels
), source_seats AS (
  SELECT source, seats, row_number() OVER (
      ORDER BY target / (2 * seat - 1) DESC, source NULLS LAST) AS place
  FROM (SELECT *, unnest(range(1, CAST(ceil(source_size / 8.0) AS BIGINT) * 3 + 1)) AS seat FROM goals)
), quotas AS (
  SELECT g.source, g.source_size, g.documents, g.target, count(s.place) AS blocks
  FROM goals g LEFT JOIN (SELECT * FROM source_seats WHERE place <= seats) s
    ON g.source IS NOT DISTINCT FROM s.source
  GROUP BY ALL
), placed AS (
  SELECT d.*, q.source_size, q.target, q.blocks,
    CAST('0x' || substr(d.place, 1, 8) AS BIGINT)
      % CAST(ceil(sqrt(q.documents)) AS BIGINT) AS shard
  FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
), shards AS (
  SELECT source, shard, blocks, CAST(sum(size) AS BIGINT) AS words,
    CAST(ceil(sum(size) / 8.0) AS BIGINT) AS own
  FROM placed GROUP BY ALL
), shard_seats AS (
  SELECT source, shard, blocks, row_number() OVER (
      PARTITION BY source ORDER BY CAST(words AS DOUBLE) / (2 * seat - 1) DESC, shard) AS place
  FROM (SELECT *, unnest(range(1, own * 3 + 1)) AS seat FROM shards)
), shard_quotas AS (
  SELECT s.source, s.shard, s.own, count(t.place) AS quota
  FROM shards s LEFT JOIN (SELECT * FROM shard_seats WHERE place <= blocks) t
    ON s.source IS NOT DISTINCT FROM t.source AND s.shard = t.shard
  GROUP BY ALL
), streams AS (
  SELECT p.*, CASE WHEN q.own > 0 THEN q.quota // q.own ELSE 0 END AS whole,
    CASE WHEN q.own > 0 THEN q.quota % q.own * 8 ELSE 0 END AS bound,
    sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.place, p.size
      ROWS UNBOUNDED PRECEDING) AS upto
  FROM placed p JOIN shard_quotas q
    ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(least(upto, bound) - upto + size, 0) AS BIGINT) AS taken
FROM streams
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
i AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS repeats FROM i GROUP BY ALL),
held AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
long AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM long),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, total WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
size AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM long, total),
scored AS (SELECT item_id, doc_id,
    sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN size USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
  doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
