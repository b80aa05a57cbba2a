"""SQL for the queries that SQL can express."""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM docs GROUP BY source
), weighed AS (
  SELECT *, ([5, 2, 1])[(place - 1) % 3 + 1] AS weight FROM sources
), tried AS (
  SELECT *, 2 * source_size * sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 2
    <= weight * (sum(source_size) OVER () * 3
      - 2 * coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM weighed
), aimed AS (
  SELECT source, source_size, CASE WHEN is_full THEN (2 * source_size)::DOUBLE
    ELSE (weight * (3 * sum(source_size) OVER () - 2 * sum(CASE WHEN is_full THEN 2 * source_size ELSE 0 END) OVER ()))::DOUBLE
      / (2 * sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM tried
), based AS (
  SELECT *, CASE WHEN target >= 2 * source_size THEN 2 WHEN target >= source_size THEN 1 ELSE 0 END AS base FROM aimed
), summed AS (
  SELECT doc_id, size, source_size, target, base, sum(size) OVER by_hash AS upto, sum(size) OVER same_hash AS together
  FROM docs JOIN based ON docs.source IS NOT DISTINCT FROM based.source
  WINDOW by_hash AS (PARTITION BY docs.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         same_hash AS (PARTITION BY docs.source, h)
)
SELECT doc_id, size, source_size, target,
       (size * (base + CASE WHEN upto - together / 2 <= target - base * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""

# The crc32 of a distinct word, bit by bit over its bytes: each is taken in by the first of its eight shifts.
RESAMPLING = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), goals AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), own AS (
  SELECT r, unnest(words) AS word FROM docs
), aimed AS (
  SELECT unnest(words) AS word FROM goals
), counted AS (
  SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t
  FROM (SELECT word, count(*) AS s, 0 AS t FROM own GROUP BY word UNION ALL SELECT word, 0, count(*) FROM aimed GROUP BY word) GROUP BY word
), hashed AS (
  SELECT word, s, t, xor(list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(range(0, octet_length(encode(word))),
             lambda i: [('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 10000 AS bucket
  FROM counted
), buckets AS (
  SELECT bucket, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM hashed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM buckets) + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM buckets) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM buckets
), weights AS (
  SELECT r, sum(gain)::BIGINT AS weight FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
         10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS many
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= many THEN place END AS rank
FROM placed
"""

ORACLES: dict[str, str] = {"op7_mixing": MIXING, "op11_resampling": RESAMPLING}
