"""The SQL that gives the same rows, for the operators that SQL can express. The others are tested by brute force."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"

BENCHMARK_HITS = f"""WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents),
  i AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM benchmark),
  j AS (SELECT *, least(10, len(words)) AS n FROM i WHERE len(words) > 0),
  starts AS (SELECT *, unnest(range(1, len(words) - n + 2)) AS p FROM j),
  windows AS (SELECT DISTINCT item_id, n, words[p : p + n - 1] AS w FROM starts),
  places AS (SELECT r, n, words, unnest(range(1, len(words) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows)),
  hits AS (SELECT r, p, places.n, item_id FROM places JOIN windows ON windows.n = places.n AND windows.w = words[p : p + places.n - 1]),
  hit_words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS k FROM hits) GROUP BY 1),
  hit_items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY 1)
  SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
  FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""

COMPONENTS = """sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach AS (SELECT a AS x, a AS y FROM sides UNION SELECT x, b FROM reach JOIN sides ON y = a),
  component AS (SELECT x, min(y) AS least FROM reach GROUP BY 1)"""

JACCARD_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS words FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, words[p : p + 4] AS s FROM (SELECT *, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM d WHERE len(words) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
  common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
  {COMPONENTS}
  SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id
  FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN component ON x = d.doc_id"""

REPEATED_STRINGS = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
  windows AS (SELECT doc_id, p, t[p : p + 49] AS w FROM (SELECT *, unnest(range(1, n - 48)) AS p FROM d)),
  least AS (SELECT w, min(doc_id) AS low, max(doc_id) AS high FROM windows GROUP BY 1),
  gone AS (SELECT doc_id, p FROM windows JOIN least USING (w) WHERE low < high AND low < doc_id),
  turns AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM gone),
  runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM turns),
  spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY 1, 2),
  edges AS (SELECT doc_id, a, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS before, b,
              lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last FROM spans),
  kept AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans,
      string_agg(CASE WHEN before < a THEN hex(t[before : a - 1]) ELSE '' END || CASE WHEN last AND b <= n THEN hex(t[b : n]) ELSE '' END, '' ORDER BY a) AS h
    FROM edges JOIN d USING (doc_id) GROUP BY 1)
  SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
    CASE WHEN h IS NULL THEN sha256(t) ELSE sha256(unhex(h)) END AS kept_sha256
  FROM d LEFT JOIN kept USING (doc_id)"""

NEAR_VECTORS = f"""WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.label = y.label AND x.vec_id < y.vec_id
            WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
  {COMPONENTS},
  degree AS (SELECT a, count(*) AS n FROM sides GROUP BY 1)
  SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
  FROM e LEFT JOIN degree ON a = vec_id LEFT JOIN component ON x = vec_id"""

BLANKS = r"[\x20\x09-\x0D]"
# The checksum of a text of ASCII characters, byte by byte with the usual table.
CRC_TABLE = """crc AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n)))"""
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

# One step of the recursion is one row; the states are n(othing), s, u and a.
INTERVAL_REPAIR = rf"""WITH RECURSIVE {CRC_TABLE},
  c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
  coded AS (SELECT *, {CRC} % 20 AS code FROM c, crc),
  damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
      CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM coded, (SELECT unnest([0, 1]) AS copy) WHERE code <> 0 AND (copy = 0 OR code = 3)),
  placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
  seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
  d AS (SELECT *, left(role, 1) AS r, CASE WHEN regexp_full_match(text, '{BLANKS}*') THEN 'blank' WHEN again THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?]{BLANKS}*$') THEN 'truncated' ELSE '' END AS fault,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM seen),
  sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
      count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
      count(*) AS n FROM d GROUP BY 1),
  inserts(p, q, k) AS (VALUES ('n', 'u', 1), ('n', 'a', 2), ('s', 'u', 1), ('s', 'a', 2), ('u', 'a', 1), ('a', 'u', 1),
      ('n', 'n', 0), ('s', 's', 0), ('u', 'u', 0), ('a', 'a', 0)),
  follows(p, q) AS (VALUES ('n', 's'), ('n', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
  edits AS (
    SELECT conv_id, i, p, p AS q, 2 AS cost, 'D' AS edit, CAST([] AS VARCHAR[]) AS line FROM d, (SELECT DISTINCT p FROM inserts)
    UNION ALL SELECT conv_id, i, p, q, CASE WHEN fault = '' THEN 0 ELSE 5 END, 'K', [role || ':' || text]
      FROM d, follows WHERE fault IN ('', 'truncated') AND q = r
    UNION ALL SELECT conv_id, i, p, q, CASE WHEN fault = '' THEN 1 ELSE 6 END, 'R',
        [CASE q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
      FROM d, follows WHERE fault IN ('', 'truncated') AND q <> 's'),
  ways AS (
    SELECT conv_id, 0 AS i, 'n' AS q, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS best FROM sums
    UNION ALL
    SELECT w.conv_id, e.i, e.q, min({{'cost': w.best.cost + 5 * x.k + e.cost, 'audit': w.best.audit || repeat('I', x.k) || e.edit,
        'lines': w.best.lines || CASE WHEN x.k = 2 THEN ['user:', 'assistant:'] WHEN x.k = 0 THEN CAST([] AS VARCHAR[])
                                      WHEN x.q = 'u' THEN ['user:'] ELSE ['assistant:'] END || e.line}})
    FROM ways w JOIN inserts x ON x.p = w.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.p = x.q
    GROUP BY 1, 2, 3),
  ends AS (SELECT w.conv_id, min(CASE WHEN w.q = 'u'
      THEN {{'cost': w.best.cost + 5, 'audit': w.best.audit || 'I', 'lines': w.best.lines || ['assistant:']}} ELSE w.best END) AS b
    FROM ways w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i WHERE w.q <> 's' GROUP BY 1)
  SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
    coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id"""

REPLY_TREES = r"""WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
  marked AS (SELECT *, replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A') AS r,
      regexp_replace(text, '<(\\*/?turn)', '<\\\1', 'g') AS t FROM c)
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<turn ' || r || '>' || chr(10) || t || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
  FROM marked GROUP BY 1"""

HARD_NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scores AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
    FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
  positives AS (SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
  SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, s AS negative_score
  FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
  WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) QUALIFY rank <= 5"""

ORACLE = {
    "op4_benchmark_hits": BENCHMARK_HITS,
    "op6_partenum_join": JACCARD_JOIN,
    "op7_repeated_strings": REPEATED_STRINGS,
    "op10_near_vectors": NEAR_VECTORS,
    "op11_interval_repair": INTERVAL_REPAIR,
    "op12_reply_trees": REPLY_TREES,
    "op13_hard_negatives": HARD_NEGATIVES,
}
