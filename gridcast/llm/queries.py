"""Queries that apply the training-data operators to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, decontam, linedup, minhash, mixing, notices, quality, repair, shard, substring, toxicity, urlfilter, warc
from .common import load


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(load(spark, sf_dir, "documents"), quality.PRODUCTION)


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(load(spark, sf_dir, "documents"))


def op4_line_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_lines(load(spark, sf_dir, "documents"))


def op5_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(load(spark, sf_dir, "documents"))


def op6_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(load(spark, sf_dir, "documents"))


def op7_blocked_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs that were seen behind a tracking link."""
    pages = load(spark, sf_dir, "pages")
    listed = pages.where(pages["url"].rlike(r"[?&]utm_")).select(urlfilter.canonical(pages["url"]).alias("canon"))
    return urlfilter.judge(pages, listed)


def op8_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    rows = mixing.shuffled(mixing.replicate(docs))
    return rows.select("doc_id", "source", F.col("__copy").alias("copy"), F.col("__order").alias("shuffle_key"))


def op10_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(load(spark, sf_dir, "embeddings"))


def op12_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans as text, ``label:first-last:edits`` in order."""
    found = notices.scan(load(spark, sf_dir, "documents"))
    parts = F.transform("spans", lambda s: F.concat(s["label"], F.lit(":"), s["first_word"], F.lit("-"), s["last_word"], F.lit(":"), s["edits"]))
    return found.withColumn("spans", F.array_join(parts, ","))


def op13_lattice_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(load(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_index,
        op2_line_frequency,
        op3_minimax_shards,
        op4_line_neighbourhood,
        op5_bag_minhash,
        op6_debruijn_spans,
        op7_blocked_bloom,
        op8_pattern_grammar,
        op9_poisson_mix,
        op10_minhash_containment,
        op11_gnat_codes,
        op12_fuzzy_notices,
        op13_lattice_repair,
    )
}

_HOST = "translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _assigned(n: int) -> str:
    """Assignment of the parts to the codebooks ``c{n}``."""
    return f"""a{n} AS MATERIALIZED (
            SELECT r, q.p, arg_min(e, (d, e)) AS e, min(d) AS d, any_value(x) AS x
            FROM (SELECT q.r, q.p, q.x, c.e, list_sum(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM q JOIN c{n} c ON q.p = c.p) q
            GROUP BY r, q.p
        )"""


def _moved(n: int) -> str:
    """Codebooks ``c{n + 1}``: floored means of the parts of ``a{n}``."""
    return f"""c{n + 1} AS MATERIALIZED (
            SELECT c.p, c.e, coalesce(m.x, c.x) AS x
            FROM c{n} c LEFT JOIN (
                SELECT p, e, list(floor(s / n)::BIGINT ORDER BY i) AS x
                FROM (SELECT p, e, i, sum(x[i])::DOUBLE AS s, count(*) AS n FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY p, e, i)
                GROUP BY p, e
            ) m ON c.p = m.p AND c.e = m.e
        )"""


def _label(label: str, cost: int | str, letter: str) -> str:
    """A lattice label (12 digits of cost, then the audit) after an edit."""
    return f"CASE WHEN {label} < '9' THEN lpad((substr({label}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({label}, 13) || '{letter}' ELSE '9' END"


def _lattice() -> str:
    """Fold of the rows' codes over the labels of the states nothing, s, u, a."""
    more = "(x[1] IN ('S', 'U', 'A', 'O'))::INT"
    stays = "x[1] NOT IN ('b', 'd')"
    when = lambda test, value: f"CASE WHEN {test} THEN {value} ELSE '9' END"
    keep = lambda role, label: when(f"x[1] IN ('{role}', '{role.upper()}')", _label(label, more, "K"))
    rerole = lambda label: when(stays, _label(label, f"2 + {more}", "R"))
    old = [f"l[{i}]" for i in range(1, 5)]
    before = (old[0], old[1], old[3])
    row = [
        _label(old[0], 3, "D"),
        f"least({_label(old[1], 3, 'D')}, {keep('s', old[0])})",
        f"least({_label(old[2], 3, 'D')}, {', '.join(keep('u', b) for b in before)}, {', '.join(map(rerole, before))})",
        f"least({_label(old[3], 3, 'D')}, {keep('a', old[2])}, {rerole(old[2])})",
    ]
    user = f"least(l[3], {', '.join(_label(b, 2, 'I') for b in before)})"
    wide = f"list_transform([[{', '.join(row)}]], lambda l: [l[1], l[2], {user}, l[4]])[1]"
    closed = f"list_transform([{wide}], lambda l: [l[1], l[2], l[3], least(l[4], {_label('l[3]', 2, 'I')})])[1]"
    zero = "lpad('0', 12, '0')"
    start = f"[{zero}, '9', lpad('2', 12, '0') || 'I', lpad('4', 12, '0') || 'II']"
    return f"list_reduce(list_prepend({start}, list_transform(codes, lambda c: [c])), lambda l, x: {closed})"


ORACLE: dict[str, str] = {
    "op1_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
        ), d AS (
            SELECT page_id, strlen(html) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
                   list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first THEN first END AS refers_to
        FROM d
    """,
    "op2_line_frequency": r"""
        WITH base AS (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), grams AS (
            SELECT r, i, list_slice(w, i, i + 2) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base)
        ), twice AS (
            SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
        ), rep AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range(3)) AS k) GROUP BY r
        ), lines AS (
            SELECT r, source, text, line, array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS norm,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
            FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM base)
        ), dup AS (
            SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE n > 0 GROUP BY r
        ), over AS (
            SELECT h.source, h.norm, CASE WHEN docs <= texts * 0.1 THEN first END AS first
            FROM (SELECT source, norm, count(DISTINCT text) AS docs, min(md5(text)) AS first FROM lines WHERE n > 0 GROUP BY source, norm) h
            JOIN (SELECT source, count(DISTINCT text) AS texts FROM base GROUP BY source) s ON h.source IS NOT DISTINCT FROM s.source
            WHERE docs >= 10
        ), hit AS (
            SELECT l.r, n, coalesce(first = md5(text), false) AS own FROM lines l JOIN over o ON l.norm = o.norm AND l.source IS NOT DISTINCT FROM o.source WHERE n > 0
        ), lost AS (
            SELECT r, sum(n) AS gone FROM hit GROUP BY r
        ), boiler AS (
            SELECT r, sum(n) FILTER (NOT (own AND depleted))::BIGINT AS n_boiler_words, count(*) FILTER (NOT (own AND depleted)) AS n_boiler_lines
            FROM (SELECT r, hit.n, own, len(w) - gone < 0.3 * len(w) AS depleted FROM hit JOIN lost USING (r) JOIN base USING (r)) GROUP BY r
        ), m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_boiler_words, 0) AS n_boiler_words, coalesce(n_boiler_lines, 0) AS n_boiler_lines
            FROM base LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN boiler USING (r)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_boiler_words >= 0.3 * n_words AS kept
        FROM m
    """,
    "op4_line_neighbourhood": r"""
        WITH lines AS (
            SELECT doc_id, i - 1 AS line_no, regexp_extract_all(s[i], '[^\x20\x09-\x0D]+') AS w
            FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))
        ), named AS (
            SELECT doc_id, line_no, array_to_string(w, ' ') AS line, w, len(w) AS n FROM lines WHERE len(w) > 0
        ), firsts AS (
            SELECT line, any_value(w) AS w, any_value(n) AS n, min((doc_id, line_no)) AS first FROM named GROUP BY line
        ), variants AS (
            SELECT line, n, first, i, array_to_string(list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, n)), ' ') AS v
            FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 8)
        ), groups AS (
            SELECT n, i, v, min(first) AS other, count(*) AS size FROM variants GROUP BY n, i, v HAVING count(*) > 1
        ), pairs AS (
            SELECT DISTINCT a.line AS long, b.line AS short, a.first AS first_long, b.first AS first_short
            FROM variants a JOIN firsts b ON a.v = b.line AND b.n >= 8
        ), links AS (
            SELECT line, size - 1 AS links, other FROM variants JOIN groups USING (n, i, v)
            UNION ALL SELECT long, 1, first_short FROM pairs
            UNION ALL SELECT short, 1, first_long FROM pairs
        ), found AS (
            SELECT line, sum(links)::BIGINT AS n_links, min(other) AS other FROM links GROUP BY line
        ), info AS (
            SELECT f.line, least(f.first, coalesce(x.other, f.first)) AS e, coalesce(n_links, 0) AS n_links
            FROM firsts f LEFT JOIN found x ON f.line = x.line
        )
        SELECT doc_id, line_no, e[1] AS first_doc_id, e[2] AS first_line_no, n_links, (doc_id, line_no) = e AS kept
        FROM named JOIN info USING (line)
    """,
    "op7_blocked_bloom": f"""
        WITH a AS (
            SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), b AS (
            SELECT page_id, url, {_HOST} AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
                       lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS q
            FROM a
        ), c AS (
            SELECT page_id, url, host, path,
                   CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www[.]', '') || regexp_replace(path, '/+$', '')
                       || CASE WHEN array_to_string(q, '&') <> '' THEN '?' || array_to_string(q, '&') ELSE '' END END AS canon
            FROM b
        ), l AS (
            SELECT DISTINCT canon AS hit FROM c WHERE regexp_matches(url, '[?&]utm_') AND canon IS NOT NULL
        ), r AS (
            SELECT page_id, host, path, hit IS NOT NULL AS listed,
                   CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM c LEFT JOIN l ON canon = hit
        )
        SELECT page_id, host, path, rule, listed,
               CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow' ELSE
                   CASE WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END END AS verdict
        FROM r
    """,
    "op9_poisson_mix": """
        WITH RECURSIVE s AS (
            SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source
        ), t AS (
            SELECT sum(weight) AS w, sum(n) AS d FROM s
        ), rate AS (
            SELECT source, weight / w * d / n AS rate FROM s, t
        ), cdf AS (
            SELECT source, rate, 0 AS k, -rate AS log, exp(-rate) AS sum FROM rate
            UNION ALL
            SELECT source, rate, k + 1, log + ln(rate) - ln(k + 1), sum + exp(log + ln(rate) - ln(k + 1)) FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 30)
        ), u AS (
            SELECT doc_id, source, ('0x' || substr(md5('20240601:draw:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents
        ), n AS (
            SELECT row_number() OVER () AS r, doc_id, source, u FROM u
        ), drawn AS (
            SELECT n.r, n.doc_id, n.source, count(*) AS copies
            FROM n JOIN cdf ON n.source IS NOT DISTINCT FROM cdf.source AND cdf.sum <= n.u GROUP BY ALL
        )
        SELECT doc_id, source, copy::INT AS copy, ('0x' || substr(md5('20240601:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
        FROM (SELECT doc_id, source, unnest(range(copies)) AS copy FROM drawn)
    """,
    "op10_minhash_containment": r"""
        WITH low AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM low)
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark
        ), wanted AS (
            SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM items)
        ), size AS (
            SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id
        )
        SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles
        FROM grams JOIN wanted USING (g) JOIN size USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_shingles)
    """,
    "op11_gnat_codes": f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), q AS MATERIALIZED (
            SELECT r, p, list_slice(v, p * len(v) // 16 + 1, (p + 1) * len(v) // 16) AS x FROM (SELECT r, v, unnest(range(16)) AS p FROM v)
        ), c0 AS MATERIALIZED (
            SELECT p, r - 1 AS e, x FROM q WHERE r <= 64
        ), {_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)}, books AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2
        ), coded AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN v USING (r), books
    """,
    "op12_fuzzy_notices": rf"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), phrases(phrase, label, words) AS (
            SELECT phrase, label, len(string_split(phrase, ' ')) FROM (VALUES {", ".join(f"('{p}', '{x}')" for p, x in notices.PHRASES.items())}) v(phrase, label)
        ), listed(notice, label, n, k, words) AS (
            SELECT notice, label, strlen(notice), strlen(notice) // 8, len(string_split(notice, ' ')) FROM (VALUES {", ".join(f"('{p}', '{x}')" for p, x in notices.NOTICES.items())}) v(notice, label)
        ), word AS MATERIALIZED (
            SELECT r, i, list(x) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING) AS run
            FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d)
        ), spanned AS MATERIALIZED (
            SELECT r, i, m, array_to_string(list_slice(run, 1, m), ' ') AS part FROM (SELECT r, i, run, unnest(range(1, len(run) + 1)) AS m FROM word)
        ), base AS (
            SELECT r, i - 1 AS place, label FROM spanned JOIN phrases ON part = phrase
        ), own AS (
            SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM base GROUP BY r
        ), edits AS (
            SELECT r, i, i + m - 1 AS j, notice, label, n, k, levenshtein(part, notice) AS e FROM spanned, listed WHERE strlen(part) BETWEEN n - k AND n + k
        ), span AS (
            SELECT r, i, notice, label, n, min((e, j)) AS best FROM edits WHERE e <= k GROUP BY r, i, notice, label, n
        ), named AS (
            SELECT r, max(1.0::DOUBLE - best[1]::DOUBLE / n::DOUBLE) AS score,
                   string_agg(label || ':' || (i - 1) || '-' || (best[2] - 1) || ':' || best[1], ',' ORDER BY i, label, best[2]) AS spans
            FROM span GROUP BY r
        ), every AS (
            SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION SELECT r, label FROM span) GROUP BY r
        ), plain AS (
            SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score, coalesce(spans, '') AS spans
        FROM d LEFT JOIN own USING (r) LEFT JOIN named USING (r) LEFT JOIN every USING (r) LEFT JOIN plain USING (r)
    """,
    "op13_lattice_repair": rf"""
        WITH crc AS MATERIALIZED (
            SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) r(b)
        ), keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS bytes
            FROM conversations
        ), hurt AS (
            SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM hurt, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
        ), line AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
                   regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS initial
            FROM damaged
        ), coded AS MATERIALIZED (
            SELECT *, CASE WHEN shown = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd' WHEN regexp_matches(shown, '[.!?]$') THEN initial ELSE upper(initial) END AS code,
                   lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) AS pair
            FROM line
        ), per AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (code = 'b') AS blank, count(*) FILTER (code = 'd') AS duplicate,
                   count(*) FILTER (code IN ('S', 'U', 'A', 'O')) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list(code ORDER BY place) AS codes
            FROM coded GROUP BY conv_id
        ), walked AS (
            SELECT *, {_lattice()} AS ends FROM per
        ), best AS MATERIALIZED (
            SELECT *, substr(least(ends[1], ends[4]), 1, 12)::BIGINT AS cost, substr(least(ends[1], ends[4]), 13) AS audit FROM walked
        ), letter AS (
            SELECT conv_id, i, x, sum((x <> 'I')::INT) OVER w AS place, sum((x <> 'D')::INT) OVER w AS nth
            FROM (SELECT conv_id, i, substr(audit, i, 1) AS x FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM best)) WINDOW w AS (PARTITION BY conv_id ORDER BY i)
        ), joined AS (
            SELECT l.conv_id, i, x, l.nth, c.role, c.text, max((x = 'K' AND l.nth = 1 AND c.initial = 's')::INT) OVER (PARTITION BY l.conv_id) AS led
            FROM letter l LEFT JOIN coded c ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.place = c.place AND x <> 'I' WHERE x <> 'D'
        ), repaired AS (
            SELECT conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
            FROM joined GROUP BY conv_id
        ), ids AS (
            SELECT DISTINCT conv_id FROM conversations
        )
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM ids LEFT JOIN best b ON ids.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN repaired t ON ids.conv_id IS NOT DISTINCT FROM t.conv_id
    """,
}
