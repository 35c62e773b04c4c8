"""DuckDB SQL of the queries that SQL can express; an independent statement of the same contract."""

from __future__ import annotations

from brinework.llm import license_scan, orchard_clustering, sharding, spelling_variants, url_filters

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_scan_sql() -> str:
    """Sentences as rows; of one over several lines, its rests as rows too."""
    known = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in license_scan.sentences().items())
    rules = ", ".join(f"({k}, {_text(name)}, {_text(',' + ','.join(ids) + ',')})" for k, (name, ids) in enumerate(license_scan.rules()))
    letters = "'[^a-z0-9]+', ' ', 'g'"
    return f"""WITH known(s, id) AS (VALUES {known}), rules(k, name, run) AS (VALUES {rules}),
t AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), '\\r', chr(10), 'g') AS t FROM documents),
b AS (SELECT r, doc_id, string_split(t, chr(10)) AS l FROM t),
p AS (SELECT r, array_to_string(list_transform(l, lambda x: regexp_replace(x, '^[^A-Za-z0-9]+', '')), chr(10)) AS t FROM b),
d AS (SELECT r, string_split(regexp_replace(regexp_replace(t, '\\n\\n+', chr(2), 'g'), '[.!?:]["'')\\]]*[ \\t\\n]+', chr(2), 'g'), chr(2)) AS l FROM p),
u AS (SELECT r, unnest(l) AS s, generate_subscripts(l, 1) AS p FROM d),
n AS (SELECT r, p, list_transform(string_split(trim(s, chr(10) || ' '), chr(10)), lambda x: trim(regexp_replace(translate(x, '{UPPER}', '{LOWER}'), {letters}), ' ')) AS l, FROM u),
m AS (SELECT r, p, trim(array_to_string(l, chr(10)), chr(10) || ' ') AS s FROM n),
k AS (SELECT r, p, string_split(s, chr(10)) AS l FROM m WHERE s <> ''),
e AS (SELECT r, p, l, unnest(range(1, len(l) + 1)) AS i FROM k),
w AS (SELECT r, p, min(i) AS i FROM e JOIN known ON array_to_string(l[i:], ' ') = known.s GROUP BY ALL),
a AS (SELECT e.r, e.p, e.i, known.id FROM e LEFT JOIN w ON e.r = w.r AND e.p = w.p LEFT JOIN known ON known.s = CASE WHEN e.i = w.i THEN array_to_string(l[e.i:], ' ') WHEN w.i IS NULL OR e.i < w.i THEN l[e.i] END),
c AS (SELECT t.r, doc_id, count(DISTINCT p) AS n_sentences, coalesce(string_agg(id, ',' ORDER BY p, i), '') AS sentence_ids FROM t LEFT JOIN a ON t.r = a.r GROUP BY ALL),
h AS (SELECT r, name, min(k) AS k FROM c JOIN rules ON contains(',' || sentence_ids || ',', run) GROUP BY r, name),
f AS (SELECT r, arg_min(name, k) AS licence, string_agg(name, ',' ORDER BY k) AS licences FROM h GROUP BY r)
SELECT doc_id, n_sentences, sentence_ids, f.licence, coalesce(f.licences, '') AS licences FROM c LEFT JOIN f USING (r)"""


def url_filters_sql(rules=url_filters.RULES, min_rate: float = url_filters.MIN_RATE, z: float = url_filters.Z) -> str:
    cases = {"rule": [], "verdict": []}
    for what, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = f"(p.host = {_text(host)} OR ends_with(p.host, {_text('.' + host)})) AND starts_with(p.path, {_text(path)})"
        cases["rule"].append(f"WHEN {fits} THEN {_text(host + path)}")
        cases["verdict"].append(f"WHEN {fits} THEN {_text(what)}")
    levels, above = "", "r_everything"
    for parent, level in (("everything", "suffix"), ("suffix", "domain"), ("domain", "host")):
        levels += f""",
o_{level} AS (SELECT {parent}, {level}, CAST(sum(good) AS BIGINT) AS good, CAST(sum(pages) AS BIGINT) AS pages FROM c GROUP BY ALL),
s_{level} AS (SELECT o.*, a.rate AS prior FROM o_{level} o JOIN {above} a ON o.{parent} = a.{parent}),
m_{level} AS (SELECT {parent}, any_value(prior * (1 - prior)) AS noise, sum(CASE WHEN pages > 0 THEN pages * (good / pages - prior) ** 2 END) / nullif(sum(pages), 0) AS spread,
    sum(pages) / nullif(count_if(pages > 0), 0) AS size FROM s_{level} GROUP BY ALL),
b_{level} AS (SELECT {parent}, noise, (spread - noise / size) / (1 - 1 / greatest(size, 2)) AS between_rates FROM m_{level}),
t_{level} AS (SELECT {parent}, CASE WHEN between_rates > 0 THEN least(greatest(noise / between_rates - 1, {url_filters.WEAKEST}), {url_filters.STRONGEST}) ELSE {url_filters.STRONGEST} END AS strength FROM b_{level}),
r_{level} AS (SELECT s.{level}, (prior * strength + good) / (strength + pages) AS rate, strength + pages AS n FROM s_{level} s JOIN t_{level} t ON s.{parent} = t.{parent})"""
        above = f"r_{level}"
    two = ", ".join(map(_text, url_filters.TWO_LABELS))
    rest = "substr(url, instr(url, '://') + 3)"
    return f"""WITH p AS (SELECT page_id, url,
  CASE WHEN contains(url, '://') THEN translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
  CASE WHEN contains(url, '://') THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
q AS (SELECT p.*, CASE WHEN last IN ({two}) THEN regexp_extract(host, '([^.]*[.])?[^.]*[.][^.]*$', 0) ELSE last END AS domain,
  CASE WHEN last IN ({two}) THEN last ELSE regexp_extract(host, '[^.]*$', 0) END AS suffix FROM (SELECT *, regexp_extract(host, '([^.]*[.])?[^.]*$', 0) AS last FROM p) p),
g AS (SELECT page_id, quality AS good FROM (SELECT page_id, try_cast(regexp_extract(url, '://[^/?#]*/[^?#0-9]*([0-9]{{1,18}})', 1) AS BIGINT) AS doc_id FROM pages) JOIN labels USING (doc_id)),
c AS (SELECT 1 AS everything, host, domain, suffix, coalesce(sum(good), 0) AS good, count(good) AS pages FROM q LEFT JOIN g ON q.page_id = g.page_id GROUP BY ALL),
r_everything AS (SELECT everything, (sum(good) + 1) / (sum(pages) + 2) AS rate FROM c GROUP BY ALL){levels}
SELECT p.page_id, p.host, p.path, CASE {' '.join(cases['rule'])} END AS rule,
CASE {' '.join(cases['verdict'])} WHEN r.rate + {z} * sqrt(r.rate * (1 - r.rate) / (r.n + 1)) < {min_rate} THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN r_host r ON p.host = r.host"""


def _advanced(register: int, half_bytes: int) -> int:
    """A checksum register after so many zero half bytes, by the reflected polynomial."""
    for _ in range(4 * half_bytes):
        register = register >> 1 ^ (0xEDB88320 if register & 1 else 0)
    return register


#: Half bytes of a text whose checksum is one fold; the parts of a text are then joined by another.
_CRC_PART = 128
#: Four bytes that take a register of zero to all ones, where a checksum starts; zeros before them change nothing.
_CRC_START = "62f52692"


def sharding_sql(shards: int = sharding.SHARDS, slots: int = sharding.SLOTS) -> str:
    """crc32 by parts of a text and half byte by half byte, and the edit of the map as a fold over lists; fit for small tables only."""
    at = "i + 1 - 2 * (i % 2)"  # the low half of a byte first
    step = [_advanced(n, 1) for n in range(16)]
    jump = " , ".join(f"{[_advanced(n << 4 * k, _CRC_PART) for n in range(16)]}[((c >> {4 * k}) & 15) + 1]" for k in range(8)).split(" , ")
    moved = jump[0]
    for part in jump[1:]:
        moved = f"xor({moved}, {part})"
    loads = f"a[1:{shards}]"
    return f"""WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, '{_CRC_START}' || lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS (SELECT r, lpad(h, CAST(ceil(length(h) / {_CRC_PART}) * {_CRC_PART} AS INT), '0') AS h FROM t),
q AS (SELECT r, k, substr(h, CAST({_CRC_PART} * k + 1 AS BIGINT), {_CRC_PART}) AS h FROM (SELECT r, h, unnest(range(length(h) // {_CRC_PART})) AS k FROM p)),
g AS (SELECT r, list(list_reduce([CAST(0 AS BIGINT)] || list_transform(range({_CRC_PART}), lambda i: CAST(instr('0123456789abcdef', substr(h, {at} + 1, 1)) - 1 AS BIGINT)),
    lambda c, b: xor({step}[(xor(c, b) & 15) + 1], c >> 4)) ORDER BY k) AS parts FROM q GROUP BY r),
c AS (SELECT doc_id, CAST((length(h) - {len(_CRC_START)}) // 2 + 1 AS BIGINT) AS size, xor(4294967295, list_reduce(parts, lambda c, b: xor({moved}, b))) AS text_crc32 FROM t JOIN g USING (r)),
d AS MATERIALIZED (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || text_crc32 || ' ' || size), 1, 8) AS BIGINT) % {slots} AS virtual_slot FROM c),
v1 AS (SELECT s AS virtual_slot, s % {shards} AS shard, CAST(coalesce(b, 0) AS BIGINT) AS b FROM (SELECT unnest(range({slots})) AS s) LEFT JOIN (SELECT virtual_slot, sum(size) AS b FROM d GROUP BY ALL) ON s = virtual_slot),
k AS (SELECT *, b = 0 OR sum(b) OVER (PARTITION BY shard ORDER BY b DESC, virtual_slot) * {shards} <= sum(b) OVER () AS stays FROM v1),
l AS (SELECT list(load ORDER BY shard) AS loads FROM (SELECT shard, CAST(coalesce(sum(b) FILTER (stays), 0) AS BIGINT) AS load FROM k GROUP BY shard)),
o AS (SELECT list([b, virtual_slot] ORDER BY b DESC, virtual_slot) AS movers FROM k WHERE NOT stays),
r AS (SELECT movers, list_reduce([loads] || movers, lambda a, x: list_transform({loads}, lambda load, i: load + CASE WHEN i = list_position({loads}, list_min({loads})) THEN x[1] ELSE 0 END)
    || a[{shards + 1}:] || [CAST(list_position({loads}, list_min({loads})) - 1 AS BIGINT)]) AS done FROM l, o),
m AS (SELECT virtual_slot, shard FROM k WHERE stays UNION ALL SELECT movers[i][2], done[{shards} + i] FROM r, (SELECT unnest(range(1, (SELECT len(movers) FROM o) + 1)) AS i))
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id, text_crc32, size) - 1 AS slot,
CAST(NULL AS INT) AS grown_shard, virtual_slot, 2 AS version FROM d JOIN m USING (virtual_slot)"""


def spelling_variants_sql() -> str:
    """Checksums by half bytes of each (document, run) once; near words by the words that are left without one letter."""
    step = [_advanced(n, 1) for n in range(16)]
    fold = f"""list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(length(h)), lambda i: CAST(instr('0123456789abcdef', substr(h, i + 1 + 1 - 2 * (i % 2), 1)) - 1 AS BIGINT)),
    lambda c, b: xor({step}[(xor(c, b) & 15) + 1], c >> 4))"""
    return f"""WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
c AS (SELECT d, run, count(*) AS n, lower(hex(encode(d || ':' || run))) AS h FROM r WHERE length(run) >= {spelling_variants.MIN_LETTERS} GROUP BY ALL),
k AS (SELECT run, n, xor(4294967295, {fold}) AS k FROM c),
x AS (SELECT n, CASE WHEN k % {spelling_variants.DAMAGE} = 0 THEN left(run, k % length(run)) || substr(run, k % length(run) + 2) ELSE run END AS word FROM k),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(word) >= {spelling_variants.MIN_LETTERS} GROUP BY ALL HAVING sum(n) >= {spelling_variants.MIN_COUNT}),
v AS MATERIALIZED (SELECT word, i, left(word, i) || substr(word, i + 2) AS v FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
near AS MATERIALIZED (SELECT DISTINCT * FROM (SELECT a.word, b.word AS other FROM v a JOIN v b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT v.word, w.word FROM v JOIN w ON v.v = w.word UNION ALL SELECT w.word, v.word FROM v JOIN w ON v.v = w.word)),
b AS (SELECT near.word, count(*) AS n_near, max(w.n) AS top, arg_min(other, (-w.n, encode(other))) AS best FROM near JOIN w ON w.word = other GROUP BY near.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN best END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n FROM w LEFT JOIN b USING (word)),
up AS (SELECT word, word AS there, 0 AS steps FROM f UNION ALL SELECT up.word, f.form, steps + 1 FROM up JOIN f ON f.word = up.there WHERE f.form IS NOT NULL),
t AS (SELECT word, arg_max(there, steps) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN t USING (word)"""


def centroid_clustering_sql() -> str:
    """Every vector beside every centroid, four times over."""
    dims, k = orchard_clustering.DIMENSIONS, orchard_clustering.CENTROIDS
    out = f"""WITH q AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({orchard_clustering.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, embedding AS e FROM embeddings
WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{orchard_clustering.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c, v FROM q QUALIFY c < {k})"""
    for n in range(orchard_clustering.ROUNDS + 1):
        gap = f"CAST(list_sum(list_transform(range(1, {dims} + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i]))) AS BIGINT)"
        out += f""",
a{n} AS MATERIALIZED (SELECT r, vec_id, q.v, c.c, {gap} AS distance FROM q, c{n} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c.c) = 1)"""
        if n < orchard_clustering.ROUNDS:
            out += f""",
s{n} AS (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, (SELECT unnest(range(1, {dims} + 1)) AS i) GROUP BY ALL),
m{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, p.v) AS v FROM c{n} p LEFT JOIN m{n} m USING (c))"""
    last = orchard_clustering.ROUNDS
    return f"""{out}
SELECT vec_id, CAST(a.c AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{last} a JOIN c{last} c USING (c)"""


ORACLE_SQL = {
    "op2_sharding": sharding_sql(),
    "op6_url_filters": url_filters_sql(),
    "op7_license_scan": license_scan_sql(),
    "op12_spelling_variants": spelling_variants_sql(),
    "op13_centroid_clustering": centroid_clustering_sql(),
}
