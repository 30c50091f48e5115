"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quarry.llm.centroids import SCALE
from quarry.llm.common import LOWER, UPPER
from quarry.llm.licenses import CONTAINMENT, FAMILY, TEMPLATES
from quarry.llm.quality import COVERED, RULES, STOP_WORDS
from quarry.llm.resampling import BUCKETS

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _verdict() -> str:
    sides = [(measure, op, value) for _, measure, least, most in RULES for op, value in ((">=", least), ("<=", most)) if value is not None]
    return " AND ".join(f"{measure} {op} {value}" for measure, op, value in sides)


_COVERED = ", ".join(f"'{x}'" for x in COVERED)
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

_TOKENS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}]+')"
_NOTICES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())



_FEATURE_WORDS = (f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
                  r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
_FEATURES = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"


def _rounds(k: int = 8, rounds: int = 10, width: int = 64) -> str:
    """The assignment and the means of every round, one after another."""
    near = """a{0} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT e.r, m.c, list_sum(list_transform(list_zip(e.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d,
           row_number() OVER (PARTITION BY e.r ORDER BY d, m.c) AS n
    FROM e CROSS JOIN m{0} m) WHERE n = 1)"""
    mean = """s{0} AS (
  SELECT c, i, sum(x)::HUGEINT AS t, count(*) AS n
  FROM (SELECT a.c, unnest(e.v) AS x, unnest(generate_series(1, {1})) AS i FROM e JOIN a{0} a USING (r)) GROUP BY c, i),
m{2} AS MATERIALIZED (
  SELECT m.c, coalesce(g.v, m.v) AS v
  FROM m{0} m LEFT JOIN (SELECT c, list(((t - ((t % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{0} GROUP BY c) g USING (c))"""
    steps = [near.format(0)]
    for i in range(rounds):
        steps += [mean.format(i, width, i + 1), near.format(i + 1)]
    return ",\n".join(steps)


SQL: dict[str, str] = {
    "op1_license_scan": rf"""
WITH t AS (SELECT license, {_TOKENS.format('notice')} AS w FROM (VALUES {_NOTICES}) AS v(license, notice)),
ts AS (SELECT DISTINCT license, array_to_string(list_slice(w, i, i + 4), ' ') AS g
       FROM (SELECT license, w, unnest(generate_series(1, len(w) - 4)) AS i FROM t)),
tm AS (SELECT license, count(*) AS m, pow(2, ceil(log2(count(*))))::BIGINT AS step FROM ts GROUP BY license),
d AS (SELECT doc_id, row_number() OVER () AS r, {_TOKENS.format('text')} AS w FROM documents),
ds AS (SELECT doc_id, r, i - 1 AS p, array_to_string(list_slice(w, i, i + 4), ' ') AS g
       FROM (SELECT doc_id, r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
hits AS (SELECT doc_id, r, p, license, g, m, step FROM ds JOIN ts USING (g) JOIN tm USING (license)),
wins AS (SELECT doc_id, r, license, m, step, g, unnest([p // step, p // step - 1]) * step AS start FROM hits),
found AS (SELECT doc_id, r, license, step, start, count(DISTINCT g)::DOUBLE / any_value(m) AS c
          FROM wins WHERE start >= 0 GROUP BY doc_id, r, license, step, start)
SELECT doc_id, license, max(c) AS containment, count(DISTINCT start) AS n_windows, arg_max(start, (c, -start)) AS first_word
FROM found WHERE c >= {CONTAINMENT} GROUP BY doc_id, license
QUALIFY max(c) = max(max(c)) OVER (PARTITION BY doc_id, CASE WHEN regexp_matches(license, '{FAMILY}') THEN 'gnu' ELSE license END)""",
    "op4_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, lang, row_number() OVER () AS r, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
starts AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
repeats AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM starts GROUP BY r),
c AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: list_contains([{_STOP}], lower(x)))) AS n_stop_words,
         coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word_chars
  FROM w LEFT JOIN repeats USING (r)),
m AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 AND coalesce(lang IN ({_COVERED}), true) THEN (n_stop_words + 1)::DOUBLE / n_words
              ELSE 1 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_ratio,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_verdict()} AS kept
FROM m""",
    "op9_substring_dedup": rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
wins AS (
  SELECT doc_id, r, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, r, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS least FROM wins GROUP BY h),
gone AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM wins JOIN firsts USING (h) WHERE doc_id > least),
cut AS (SELECT r, unnest(generate_series(i, least(i + 49, coalesce(nxt - 1, i + 49)))) AS p FROM gone),
lists AS (SELECT r, count(*) AS n FROM cut GROUP BY r),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS k
  FROM (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM w WHERE r IN (SELECT r FROM lists))
  WHERE (r, p) NOT IN (SELECT r, p FROM cut) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k, '') END) AS kept_sha256
FROM w LEFT JOIN lists USING (r) LEFT JOIN kept USING (r)""",
    "op11_filtered_kmeans": f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v
  FROM (SELECT vec_id, v, sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h FROM e ORDER BY h, vec_id, v LIMIT 8)),
{_rounds()}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m10.v, ',')) AS centroid_sha256
FROM a10 JOIN e USING (r) JOIN m10 USING (c)""",
    "op12_digest_index": f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM t""",
    "op13_importance_resampling": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_FEATURE_WORDS} AS w FROM documents),
b AS (SELECT {_FEATURE_WORDS} AS w FROM benchmark),
df AS (SELECT r, unnest({_FEATURES}) AS f FROM d),
bf AS (SELECT unnest({_FEATURES}) AS f FROM b),
step AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS t),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(1, len(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
             lambda a, y: xor(a >> 8, t[xor(a & 255, y) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket
  FROM hexed, step),
s AS (SELECT bucket, count(*) AS n FROM df JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT g.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE
           / ((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM range({BUCKETS}) g(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS g FROM df JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, r, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
         CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums USING (r)),
noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS k,
                  count(*) OVER (PARTITION BY n_words >= 20) AS n_open FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND 100 * k <= 25 * n_open THEN k END AS rank
FROM ranked""",
}
