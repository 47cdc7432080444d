"""SQL over the same tables, for the queries that SQL can express."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)

_ORACLES["op5_topk"] = """
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.place <> c.place
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
  FROM scores
)
SELECT query_id, vec_id, score, "rank" FROM ranked WHERE "rank" <= 20
"""

_ORACLES["op8_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), originals AS (
  SELECT payload, max(page_id) AS original FROM payloads GROUP BY payload
), joined AS (
  SELECT page_id, payload, octet_length(encode(payload)) AS n, original FROM payloads JOIN originals USING (payload)
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> original THEN original END AS refers_to,
  true AS sound
FROM joined
"""

_ORACLES["op4_repeats"] = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM docs, unnest(generate_series(0, n - 50)) AS t(i) WHERE n >= 50
), least AS (
  SELECT s, min(doc_id) AS first FROM windows GROUP BY s
), hits AS (
  SELECT windows.doc_id, i FROM windows JOIN least USING (s) WHERE first < windows.doc_id
), marked AS (
  SELECT *, coalesce(i > lag(i) OVER w + 50, true) AS fresh FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), runs AS (
  SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL
), cuts AS (
  SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
  FROM cuts JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

_ORACLES["op11_periodic_runs"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda s, c: list_reduce(list_prepend(xor(s, c), CAST(range(8) AS BIGINT[])), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))
    )) AS h
  FROM documents
), sized AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 END AS g FROM texts
), places AS (
  SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized
), words AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM places, unnest(range(n)) AS t(i)
), equal AS (
  SELECT x.doc_id, x.i, x.i - y.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i
  WHERE x.i - y.i <= x.n // 4
), stretches AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM equal
), matches AS (
  SELECT doc_id, q, min(i) - q AS s, count(*) + q AS length FROM stretches GROUP BY doc_id, q, stretch
), runs AS (
  SELECT doc_id, s, length, min(q) AS q FROM matches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, s, length
), summary AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    min({'l': -length, 's': s, 'q': q}) AS best
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, i FROM runs, unnest(range(s + q, s + length)) AS t(i)
), rest AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best['s'] AS BIGINT) AS start, CAST(-best['l'] AS BIGINT) AS length,
  CAST(best['q'] AS BIGINT) AS period, CAST(1000 * -best['l'] // best['q'] AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN summary USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

_BOOK = """, near{r} AS (
  SELECT vec_id, part, {least} AS best FROM (
    SELECT vec_id, part, entry, sum((v.x - b.x) * (v.x - b.x)) AS d FROM cells v JOIN book{r} b USING (part, place)
    GROUP BY vec_id, part, entry
  ) GROUP BY vec_id, part
)"""
_REFIT = """, book{n} AS (
  SELECT part, entry, place, coalesce(m, x) AS x FROM book{r} LEFT JOIN (
    SELECT part, best['entry'] AS entry, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM cells JOIN near{r} USING (vec_id, part) GROUP BY ALL
  ) USING (part, entry, place)
)"""
_LEAST = "min({'d': d, 'entry': entry})"
_ORACLES["op12_vector_codes"] = (
    """
WITH kept AS (
  SELECT vec_id, label, embedding AS e, len(embedding) // 16 AS width, row_number() OVER (ORDER BY vec_id) - 1 AS seat FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS (
  SELECT vec_id, seat, (i - 1) // width AS part, (i - 1) % width AS place, CAST(floor(256 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, unnest(range(1, len(e) + 1)) AS t(i)
), book0 AS (
  SELECT part, seat AS entry, place, x FROM cells WHERE seat < 64
)"""
    + _BOOK.format(r=0, least=_LEAST)
    + _REFIT.format(r=0, n=1)
    + _BOOK.format(r=1, least=_LEAST)
    + _REFIT.format(r=1, n=2)
    + _BOOK.format(r=2, least=_LEAST)
    + """, coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(best['entry'] AS INTEGER))), '' ORDER BY part) AS code, sum(best['d']) AS error
  FROM near2 GROUP BY vec_id
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
)
