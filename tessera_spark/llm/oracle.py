"""SQL twins, for DuckDB."""

from __future__ import annotations

#: CRC-32 of the text's bytes, one byte at a time; the table follows from the polynomial.
SHARDING = """
WITH steps AS (
    SELECT list(value ORDER BY k) AS crc_table FROM (
        SELECT k, list_reduce([k] || range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS value
        FROM range(256) t(k))),
bytes AS (
    SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
    SELECT doc_id, length(h) // 2 + 1 AS size,
        xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
            lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM bytes, steps),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY text_crc32, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, CAST((2 * start + size) * 16 // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

#: Sharing out the excess again and again ends at the level of the first source, by limit over
#: weight, that stays below its limit.
MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source))) - 1) % 3 + 1]::DOUBLE AS w, (source_size * 2)::DOUBLE AS most FROM sums),
levels AS (
    SELECT *, sum(source_size) OVER () * 150 / 100.0::DOUBLE AS budget, sum(w) OVER () AS all_w,
        coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(w) OVER o, 0) AS w_before,
        row_number() OVER (ORDER BY most / w, source IS NULL, encode(source)) AS place
    FROM weighed WINDOW o AS (ORDER BY most / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tried AS (SELECT *, (budget - most_before) / (all_w - w_before) AS level FROM levels),
final AS (SELECT level FROM tried WHERE level * w <= most ORDER BY place LIMIT 1),
targets AS (SELECT source, source_size, least(most, coalesce((SELECT level FROM final) * w, most)) AS target FROM tried),
drawn AS (
    SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN least(2.0::DOUBLE, t.target * 1.0::DOUBLE / t.source_size::DOUBLE) ELSE 0.0::DOUBLE END AS expected,
        (('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
odds AS (SELECT *, CAST(floor(expected) AS BIGINT) AS certain, expected - floor(expected) AS p FROM drawn),
ranked AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS q FROM odds),
ordered AS (
    SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS room,
        coalesce(sum(size) OVER (PARTITION BY source ORDER BY q / (1 + q) NULLS LAST, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM ranked),
taken AS (SELECT *, certain + CASE WHEN p > 0 AND ahead + size / 2.0 <= room THEN 1 ELSE 0 END AS copies FROM ordered)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies FROM taken
"""

#: Links between different sets, found by counting shared shingles; components by reachability.
JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS n, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT n, doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
nodes AS (SELECT s, row_number() OVER () AS node, len(s) AS size FROM (SELECT DISTINCT s FROM sets WHERE len(s) > 0)),
shingles AS (SELECT node, size, unnest(s) AS g FROM nodes),
links AS (
    SELECT a.node AS x, b.node AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.node <> b.node
    GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))),
reach AS (SELECT node AS x, node AS y FROM nodes UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_id AS (SELECT s.s, min(s.doc_id) AS low FROM sets s WHERE len(s.s) > 0 GROUP BY s.s),
named AS (SELECT r.x, min(i.low) AS component_id FROM reach r JOIN nodes m ON m.node = r.y JOIN least_id i ON i.s = m.s GROUP BY r.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE c.component_id END AS component_id
FROM sets s LEFT JOIN nodes m ON m.s = s.s LEFT JOIN named c ON c.x = m.node
"""

#: The neighbour in a circle by a window over all rows, sketches by lists of MD5 prefixes.
FINGERPRINTS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (
    SELECT doc_id, t, length(t) AS c, coalesce(lead(t) OVER o, first_value(t) OVER o) AS other
    FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, t)),
e AS (SELECT *, substr(t, 1, c - c // 3) || substr(other, 1, c // 3) AS edited FROM n),
w AS (
    SELECT *, list_transform([t, edited, other], lambda x: regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words FROM e),
s AS (
    SELECT *, list_transform(words, lambda w: list_sort(list_distinct(list_filter(
        CASE WHEN len(w) > 0 THEN list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda k: substr(md5(array_to_string(w[k : k + 4], ' ')), 1, 16)) ELSE [] END,
        lambda h: h < '4000')))) AS k
    FROM w),
j AS (
    SELECT *, len(list_intersect(k[1], k[2])) AS both_e, len(list_distinct(k[1] || k[2])) AS all_e,
        len(list_intersect(k[1], k[3])) AS both_n, len(list_distinct(k[1] || k[3])) AS all_n
    FROM s)
SELECT doc_id, CAST(c AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
    md5(t) || ':' || coalesce(array_to_string(k[1], ','), '') AS fingerprint, md5(edited) || ':' || coalesce(array_to_string(k[2], ','), '') AS edited_fingerprint,
    CASE WHEN all_e > 0 THEN both_e::DOUBLE / all_e::DOUBLE WHEN t = edited THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS near_edited,
    CASE WHEN all_n > 0 THEN both_n::DOUBLE / all_n::DOUBLE WHEN t = other THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS near_next
FROM j
"""

#: All scores of all anchors, ranked by windows.
HARD_NEGATIVES = """
WITH sound AS (
    SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, b.n AS other, b.vec_id AS id, a.label = b.label AS same,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * b.v[k])) AS BIGINT) AS score
    FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND a.n <> b.n),
positives AS (
    SELECT anchor, anchor_id, other, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) <= 5),
ranked AS (
    SELECT p.*, s.id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.id NULLS LAST) AS INTEGER) AS rank
    FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


def _conversation_repair() -> str:
    """The same search by recursion over the rows of a conversation: each state holds (cost, edits,
    repaired lines), and the least of them is taken."""
    never = "{'c': 1000000000, 'a': '', 'r': ''}"

    def step(of: str, cost: str, edit: str, line: str = "", allowed: str = "true") -> str:
        return f"{{'c': CASE WHEN {allowed} THEN {of}.c + {cost} ELSE 1000000000 END, 'a': {of}.a || '{edit}', 'r': {of}.r{' || ' + line if line else ''}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def insert(of: str, role: str) -> str:
        return step(of, "5", "I", f"chr(10) || '{role}:'")

    def row(of: str, initial: str, rerole: str | None) -> list[str]:
        keep = step(of, "5 * truncated", "K", "chr(10) || role || ':' || text", f"NOT must_go AND initial = '{initial}'")
        return [keep] + ([step(of, "1 + 5 * truncated", "R", f"chr(10) || '{rerole}:' || text", "NOT must_go")] if rerole else [])

    def inserted(source: str, columns: str) -> str:
        first = f"SELECT {columns}, s[1] AS t0, s[2] AS t1, s[4] AS s3, {least('s[3]', insert('s[1]', 'user'), insert('s[2]', 'user'))} AS u FROM {source}"
        return f"SELECT {columns}, t0, t1, {least('u', insert('s3', 'user'))} AS t2, {least('s3', insert('u', 'assistant'))} AS t3 FROM ({first})"

    after = [
        step("t0", "2", "D"),
        least(step("t1", "2", "D"), *row("t0", "s", None)),
        least(step("t2", "2", "D"), *row("t0", "u", "user"), *row("t1", "u", "user"), *row("t3", "u", "user")),
        least(step("t3", "2", "D"), *row("t2", "a", "assistant")),
    ]
    columns = "g, i, role, text, initial, must_go, truncated"
    joined = "(SELECT w.g, w.s, r.i, r.role, r.text, r.initial, r.must_go, r.truncated FROM walk w JOIN faults r ON r.g = w.g AND r.i = w.i + 1)"
    return rf"""
WITH RECURSIVE steps AS (
    SELECT list(value ORDER BY k) AS crc_table FROM (
        SELECT k, list_reduce([k] || range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS value
        FROM range(256) t(k))),
named AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
kinds AS (
    SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, length(name) + 1), lambda k: ascii(substr(name, k, 1))::BIGINT),
        lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM named, steps),
convs AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
    SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM kinds k JOIN convs c ON k.conv_id IS NOT DISTINCT FROM c.conv_id WHERE kind <> 0),
numbered AS (
    SELECT *, substr(role, 1, 1) AS initial, row_number() OVER o AS i, lag(substr(role, 1, 1)) OVER o AS before,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
    FROM damaged WINDOW o AS (PARTITION BY g ORDER BY turn NULLS FIRST, role, text)),
seen AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth FROM numbered),
faults AS (
    SELECT *, CAST(NOT blank AND nth > 1 AS INTEGER) AS duplicate, blank OR nth > 1 AS must_go,
        CAST(NOT blank AND nth = 1 AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS INTEGER) AS truncated,
        CAST(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS INTEGER) AS illegal
    FROM seen),
walk AS (
    SELECT g, 0::BIGINT AS i, [{{'c': 0, 'a': '', 'r': ''}}, {never}, {never}, {never}] AS s FROM convs
    UNION ALL
    SELECT g, i, [{", ".join(after)}] AS s FROM ({inserted(joined, columns)})),
ends AS (SELECT g, arg_max(s, i) AS s FROM walk GROUP BY g),
chosen AS (SELECT g, {least("t0", "t3")} AS e FROM ({inserted("ends", "g")})),
counted AS (
    SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, sum(duplicate) AS duplicate,
        sum(truncated) AS truncated, sum(illegal) AS illegal
    FROM faults GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
    CAST(e.c AS BIGINT) AS cost, e.a AS audit, sha256(substr(e.r, 2)) AS repaired_sha256
FROM convs JOIN chosen USING (g) LEFT JOIN counted USING (g)
"""


CONVERSATION_REPAIR = _conversation_repair()
