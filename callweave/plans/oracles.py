"""DuckDB SQL with the rows of the core's queries."""

from __future__ import annotations

_RAW = """raw AS (SELECT DISTINCT file, pos, start AS s, "end" AS e, text FROM raw_chunks),
    spoken AS (SELECT file, pos, s, e, regexp_replace(text, '\\s+$', '') AS text FROM raw WHERE text IS NOT NULL AND regexp_matches(text, '\\S'))"""
_AUDIO = "audio AS (SELECT file, max(coverage.audio_seconds) AS audio_seconds FROM stt_timestamps GROUP BY file)"
_CHUNKS = """rec AS (SELECT file, any_value(chunks) AS chunks, any_value(speaker) AS speaker, any_value(coverage) AS coverage FROM stt_timestamps GROUP BY file),
    ix AS (SELECT file, chunks, speaker, unnest(range(1, len(chunks) + 1)) AS i FROM rec),
    chunks AS (SELECT file, i - 1 AS pos, chunks[i].start AS s, coalesce(chunks[i]."end", chunks[i].start) AS e, chunks[i].text AS text, speaker[i] AS speaker FROM ix)"""
_TURNS = """tn AS (SELECT DISTINCT file, start AS s, "end" AS e, label FROM turns WHERE start IS NOT NULL AND "end" IS NOT NULL)"""
_TEXTS = "texts AS (SELECT DISTINCT file, text FROM text_files WHERE text IS NOT NULL)"


# Equal rows count once: two windows may order them differently, and only one of them opens an island.
def _union(source: str, name: str, gap: float, keep_empty: bool = False) -> str:
    return f"""{name}_m AS (SELECT file, s, e, max(e) OVER (PARTITION BY file ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT file, s, e FROM {source} {"" if keep_empty else "WHERE e > s"})),
    {name}_i AS (SELECT *, sum(CASE WHEN s <= reach + {gap}::DOUBLE THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM {name}_m),
    {name} AS (SELECT file, island, min(s) AS s, max(e) AS e FROM {name}_i GROUP BY file, island)"""


_GAPS = f"""{_CHUNKS}, {_TURNS}, {_union("tn", "speech", 0.1)},
    wide AS (SELECT file, greatest(0.0::DOUBLE, s - 0.15::DOUBLE) AS s, e + 0.15::DOUBLE AS e FROM chunks), {_union("wide", "words", 0.05)},
    hit AS (SELECT a.file, a.s AS a_s, a.e AS a_e, CASE WHEN w.s IS NOT NULL THEN greatest(w.s, a.s) END AS w_s, CASE WHEN w.s IS NOT NULL THEN least(w.e, a.e) END AS w_e FROM speech a LEFT JOIN words w ON a.file = w.file AND w.s < a.e AND w.e > a.s),
    piece AS (
        SELECT file, coalesce(lag(w_e) OVER (PARTITION BY file, a_s ORDER BY w_s), a_s) AS s, coalesce(w_s, a_e) AS e FROM hit
        UNION ALL SELECT file, max(w_e), any_value(a_e) FROM hit WHERE w_e IS NOT NULL GROUP BY file, a_s
    ),
    long AS (SELECT * FROM piece WHERE e - s >= 1.0), {_union("long", "gaps", 0.1)}"""

_FILL = f"""{_RAW}, {_AUDIO},
    nx AS (SELECT f.*, a.audio_seconds AS ae, first_value(s IGNORE NULLS) OVER (PARTITION BY f.file ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns FROM spoken f LEFT JOIN audio a USING (file)),
    ls AS (SELECT file, list_prepend({{'pos': -1::BIGINT, 's': NULL::DOUBLE, 'e': NULL::DOUBLE, 'ns': NULL::DOUBLE, 'ae': NULL::DOUBLE, 'pe': 0.0::DOUBLE, 'out': []::STRUCT(pos BIGINT, s DOUBLE, e DOUBLE)[]}},
        list({{'pos': pos, 's': s, 'e': e, 'ns': ns, 'ae': ae, 'pe': 0.0::DOUBLE, 'out': []::STRUCT(pos BIGINT, s DOUBLE, e DOUBLE)[]}} ORDER BY pos)) AS l FROM nx GROUP BY file),
    fd AS (SELECT file, unnest(list_reduce(l, lambda a, x: {{'pos': x.pos, 's': x.s, 'e': x.e, 'ns': x.ns, 'ae': x.ae,
        'pe': coalesce(x.e, CASE WHEN x.ns > coalesce(x.s, a.pe) THEN x.ns WHEN x.ae > coalesce(x.s, a.pe) THEN x.ae ELSE coalesce(x.s, a.pe) END),
        'out': list_append(a.out, {{'pos': x.pos, 's': coalesce(x.s, a.pe), 'e': coalesce(x.e, CASE WHEN x.ns > coalesce(x.s, a.pe) THEN x.ns WHEN x.ae > coalesce(x.s, a.pe) THEN x.ae ELSE coalesce(x.s, a.pe) END)}})}}).out) AS r FROM ls),
    filled AS (SELECT file, r.pos AS pos, r.s AS s, r.e AS e FROM fd)"""


def _repair(source: str) -> str:
    return f"""rl AS (SELECT file, list_prepend({{'pos': -1::BIGINT, 's': NULL::DOUBLE, 'e': NULL::DOUBLE, 'o': 0.0::DOUBLE, 'pe': 0.0::DOUBLE, 'out': []::STRUCT(pos BIGINT, s DOUBLE, e DOUBLE, reset BOOLEAN)[]}},
        list({{'pos': pos, 's': s, 'e': e, 'o': 0.0::DOUBLE, 'pe': 0.0::DOUBLE, 'out': []::STRUCT(pos BIGINT, s DOUBLE, e DOUBLE, reset BOOLEAN)[]}} ORDER BY pos)) AS l FROM {source} GROUP BY file),
    rf AS (SELECT file, unnest(list_reduce(l, lambda a, x: {{'pos': x.pos, 's': x.s, 'e': x.e,
        'o': CASE WHEN x.s + a.o < a.pe - 0.5 THEN a.pe - x.s ELSE a.o END,
        'pe': greatest(x.e, x.s) + CASE WHEN x.s + a.o < a.pe - 0.5 THEN a.pe - x.s ELSE a.o END,
        'out': list_append(a.out, {{'pos': x.pos, 's': x.s + CASE WHEN x.s + a.o < a.pe - 0.5 THEN a.pe - x.s ELSE a.o END,
            'e': greatest(x.e, x.s) + CASE WHEN x.s + a.o < a.pe - 0.5 THEN a.pe - x.s ELSE a.o END, 'reset': x.s + a.o < a.pe - 0.5}})}}).out) AS r FROM rl),
    repaired AS (SELECT file, r.pos AS pos, r.s AS s, r.e AS e, r.reset AS reset FROM rf)"""


_NUMBERED = f"{_TURNS}, nt AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY s, e, label) AS turn FROM tn)"
_MS = """cm AS (SELECT file, pos, CAST(round(s * 1000) AS BIGINT) AS s, CAST(round(e * 1000) AS BIGINT) AS e, text FROM chunks),
    nm AS (SELECT file, CAST(round(s * 1000) AS BIGINT) AS s, CAST(round(e * 1000) AS BIGINT) AS e, label FROM tn),
    nn AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY s, e, label) AS turn FROM nm)"""
_OVER = """ov AS (SELECT c.file, c.pos, max_by({'l': n.label, 'o': least(c.e, n.e) - greatest(c.s, n.s)}, {'o': least(c.e, n.e) - greatest(c.s, n.s), 't': -n.turn}) AS b
        FROM cm c JOIN nn n ON c.file = n.file AND least(c.e, n.e) > greatest(c.s, n.s) GROUP BY c.file, c.pos)"""
_NEAR = """an AS (SELECT file, pos, CASE WHEN e > s THEN (s + e) / 2.0 ELSE s END AS m FROM cm),
    nr AS (SELECT a.file, a.pos, min_by(n.label, {'d': CASE WHEN a.m BETWEEN n.s AND n.e THEN 0 ELSE least(abs(a.m - n.s), abs(a.m - n.e)) END, 't': n.turn}) AS label FROM an a JOIN nn n USING (file) GROUP BY a.file, a.pos)"""
_ASSIGNED = f"{_CHUNKS}, asg AS (SELECT file, pos, s, e, text, lower(trim(speaker, ' ')) AS speaker FROM chunks)"
_WT = f"""{_ASSIGNED}, wm AS (SELECT file, pos, speaker, CAST(round(s * 1000) AS BIGINT) AS s, CAST(round(e * 1000) AS BIGINT) AS e, trim(text, ' ') AS word FROM asg),
    wb AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR speaker IS DISTINCT FROM lag(speaker) OVER w OR s - lag(e) OVER w > 1000 THEN 1 ELSE 0 END AS opens FROM wm WINDOW w AS (PARTITION BY file ORDER BY pos)),
    wr AS (SELECT *, sum(opens) OVER (PARTITION BY file ORDER BY pos ROWS UNBOUNDED PRECEDING) AS turn FROM wb),
    wt AS (SELECT file, CAST(turn AS INT) AS turn, any_value(speaker) AS speaker, arg_min(s, pos) AS s, arg_max(e, pos) AS e, string_agg(word, ' ' ORDER BY pos) AS words FROM wr GROUP BY file, turn)"""
_NAME = "CASE WHEN speaker IS NULL THEN 'UNASSIGNED' ELSE 'Speaker ' || speaker END"


def _clock(c: str) -> str:
    ms = f"CAST(floor({c} / 1000.0::DOUBLE * 1000) AS BIGINT)"  # seconds first: fractions are cut off after that
    return f"printf('%02d:%02d:%02d,%03d', {ms} // 3600000, {ms} % 3600000 // 60000, {ms} % 60000 // 1000, {ms} % 1000)"


def _lines(source: str, speaker: bool) -> str:
    joined = "CASE WHEN regexp_matches(x.text, '^\\s') THEN a.text || x.text ELSE a.text || ' ' || x.text END"
    goes_on = f"a.pos >= 0 AND {'x.speaker IS NOT DISTINCT FROM a.speaker AND ' if speaker else ''}NOT (x.s - a.e > 1.0) AND length({joined}) <= 300"
    fields = "'pos': {0}pos, 's': {0}s, 'e': {0}e, 'text': {0}text, 'speaker': {0}speaker, "
    first = "{'pos': -1::BIGINT, 's': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 'text': '', 'speaker': '', 'ls': 0.0::DOUBLE, 'out': []::STRUCT(s DOUBLE, e DOUBLE, text VARCHAR, speaker VARCHAR)[]}"
    item = "{" + fields.format("") + "'ls': 0.0::DOUBLE, 'out': []::STRUCT(s DOUBLE, e DOUBLE, text VARCHAR, speaker VARCHAR)[]}"
    done = "{'s': a.ls, 'e': a.e, 'text': a.text, 'speaker': a.speaker}"
    return f"""ll AS (SELECT file, list_prepend({first}, list({item} ORDER BY pos)) AS l FROM {source} GROUP BY file),
    lr AS (SELECT file, list_reduce(l, lambda a, x: {{'pos': x.pos, 's': x.s, 'e': x.e, 'text': CASE WHEN {goes_on} THEN {joined} ELSE ltrim(x.text) END, 'speaker': x.speaker,
        'ls': CASE WHEN {goes_on} THEN a.ls ELSE x.s END, 'out': CASE WHEN a.pos < 0 OR {goes_on} THEN a.out ELSE list_append(a.out, {done}) END}}) AS a FROM ll),
    lo AS (SELECT file, list_append(a.out, {done}) AS o FROM lr),
    lx AS (SELECT file, o, unnest(range(1, len(o) + 1)) AS line FROM lo),
    lines AS (SELECT file, CAST(line AS INT) AS line, o[line].speaker AS speaker, o[line].s AS s, o[line].e AS e, o[line].text AS text FROM lx)"""


_DIGITS = "regexp_replace({0}, '[^\\p{{Nd}}]', '', 'g')"
_REG = f"""reg AS (SELECT list_sort(list_transform(list_distinct(list_transform(phone_numbers, lambda p: {_DIGITS.format("p")})), lambda d: {{'n': -length(d), 'v': d}})) AS phones,
        list_sort(list_transform(list_distinct(names), lambda d: {{'n': -length(d), 'v': d}})) AS names FROM registry)"""


def _masked_phones(text: str) -> str:
    # no look-around here: the characters beside a number are matched and put back; twice, as two numbers may share one
    pattern = "'(^|[^\\p{Nd}])' || array_to_string(string_split(p, ''), '[ \\t().-]*') || '($|[^\\p{Nd}])'"

    def once(x: str) -> str:
        return f"regexp_replace({x}, {pattern}, '\\1[전화번호]\\2', 'g')"

    return f"list_reduce(list_prepend({text}, list_transform(phones, lambda q: q.v)), lambda acc, p: {once(once('acc'))})"


_LINES_OF = "string_split_regex({0}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')"
_LINES = "CASE WHEN {0} = '' THEN []::VARCHAR[] WHEN " + _LINES_OF + "[-1] = '' THEN " + _LINES_OF + "[:-2] ELSE " + _LINES_OF + " END"
_TAG = "\\[이름\\]|\\[생년월일\\]|\\[전화번호\\]"
_RESULTS = f"""rec AS (SELECT file, any_value(coverage) AS coverage FROM stt_timestamps GROUP BY file), {_TEXTS},
    res AS (SELECT regexp_replace(file, '\\.wav$', '.txt') AS file, coalesce(coverage.short_transcript, false) AS short FROM rec),
    st AS (SELECT file, short, CASE WHEN file NOT IN (SELECT file FROM texts) THEN 'failed' WHEN file IN (SELECT file FROM anonymization WHERE text IS NOT NULL) THEN 'skipped' ELSE 'succeeded' END AS status,
        CAST(nullif(regexp_extract(file, 'team-(\\d+)', 1), '') AS INT) AS shard FROM res)"""
_SUMMARY = "count(*) AS total, count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (short) AS short_transcripts"
_FRESH = f"""{_RAW}, {_CHUNKS},
    fr AS (SELECT file, pos, s, e, lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS w, (s + e) / 2 AS m FROM spoken WHERE s IS NOT NULL AND e IS NOT NULL),
    og AS (SELECT file, lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS w, (s + e) / 2 AS m FROM chunks),
    cand AS (SELECT * FROM fr WHERE NOT EXISTS (SELECT 1 FROM og WHERE og.file = fr.file AND og.w = fr.w AND abs(og.m - fr.m) <= 0.5)),
    cl AS (SELECT file, w, list_prepend({{'pos': -1::BIGINT, 'm': 0.0::DOUBLE, 's': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 'k': []::STRUCT(pos BIGINT, m DOUBLE, s DOUBLE, e DOUBLE)[]}},
        list({{'pos': pos, 'm': m, 's': s, 'e': e, 'k': []::STRUCT(pos BIGINT, m DOUBLE, s DOUBLE, e DOUBLE)[]}} ORDER BY pos)) AS l FROM cand GROUP BY file, w),
    kept AS (SELECT file, unnest(list_reduce(l, lambda a, x: {{'pos': x.pos, 'm': x.m, 's': x.s, 'e': x.e,
        'k': CASE WHEN len(list_filter(a.k, lambda y: abs(y.m - x.m) <= 0.5)) > 0 THEN a.k ELSE list_append(a.k, {{'pos': x.pos, 'm': x.m, 's': x.s, 'e': x.e}}) END}}).k) AS r FROM cl)"""

def _differing(p: str, source: str) -> str:
    """Blocks in which the lists x and y of the rows (id, x, y) differ: the longest common run parts a segment in two, the first one of equal runs."""
    best = f"""SELECT g.id, alo, ahi, blo, bhi, max({{'l': least(r.t + 1, ahi, bhi + r.d) - greatest(r.s, alo, blo + r.d), 's': -greatest(r.s, alo, blo + r.d), 'j': r.d - greatest(r.s, alo, blo + r.d)}}) AS m
        FROM {p}g g JOIN {p}r r ON g.id = r.id AND least(r.t + 1, ahi, bhi + r.d) > greatest(r.s, alo, blo + r.d) GROUP BY g.id, alo, ahi, blo, bhi"""
    return f"""{p}x AS (SELECT id, x, unnest(range(1, len(x) + 1)) AS i FROM {source}), {p}y AS (SELECT id, y, unnest(range(1, len(y) + 1)) AS j FROM {source}),
    {p}e AS (SELECT a.id, i, i - j AS d, i - row_number() OVER (PARTITION BY a.id, i - j ORDER BY i) AS grp FROM {p}x a JOIN {p}y b ON a.id = b.id AND a.x[i] = b.y[j]),
    {p}r AS (SELECT id, d, min(i) AS s, max(i) AS t FROM {p}e GROUP BY id, d, grp),
    {p}g AS (SELECT id, 1::BIGINT AS alo, len(x) + 1 AS ahi, 1::BIGINT AS blo, len(y) + 1 AS bhi FROM {source}
        UNION ALL SELECT id, CASE WHEN side = 0 THEN alo ELSE -m.s + m.l END, CASE WHEN side = 0 THEN -m.s ELSE ahi END, CASE WHEN side = 0 THEN blo ELSE -m.j + m.l END, CASE WHEN side = 0 THEN -m.j ELSE bhi END
            FROM ({best}) b, (VALUES (0), (1)) v(side)),
    {p}m AS (SELECT id, -m.s AS a, -m.j AS b, m.l AS l FROM ({best}) UNION ALL SELECT id, len(x) + 1, len(y) + 1, 0 FROM {source}),
    {p}h AS (SELECT id, coalesce(lag(a + l) OVER w, 1) AS a0, a AS a1, coalesce(lag(b + l) OVER w, 1) AS b0, b AS b1 FROM {p}m WINDOW w AS (PARTITION BY id ORDER BY a, b)),
    {p} AS (SELECT * FROM {p}h WHERE a1 > a0 OR b1 > b0)"""


_SHAPED = """CASE {t} WHEN '[전화번호]' THEN length(regexp_replace({v}, '[^\\p{{Nd}}]', '', 'g')) BETWEEN 7 AND 15 AND regexp_full_match({v}, '\\+?[0-9][0-9 \\t().-]*[0-9]')
        WHEN '[생년월일]' THEN length({v}) <= 40 AND length(regexp_replace({v}, '[^\\p{{Nd}}]', '', 'g')) >= 4 AND regexp_full_match({v}, '[0-9][0-9년월일생 \\t./-]*[0-9일생]')
        ELSE {v} <> '' AND length({v}) <= 20 AND NOT regexp_matches({v}, '\\p{{Nd}}') AND NOT regexp_matches({v}, '[,.:;!?/()\\[\\]{{}}]') END"""
_TOKENS = "regexp_extract_all({0}, '(?s)" + _TAG + "|.')"
# (anon_id, line, part, item, tag, value, reason) of all tags: lines are paired, parts looked up or lines compared, stretches of several tags cut
_REDACTED = f"""RECURSIVE {_TEXTS}, b AS (SELECT a.anon_id AS id, {_LINES.format("t.text")} AS x, {_LINES.format("a.text")} AS y FROM anonymization a JOIN texts t USING (file) WHERE a.text IS NOT NULL),
    ue AS (SELECT * FROM b WHERE len(x) <> len(y)), {_differing("lb", "ue")},
    bl AS (SELECT * FROM lb UNION ALL SELECT id, 1, len(x) + 1, 1, len(y) + 1 FROM b WHERE len(x) = len(y)),
    pl AS (SELECT id, a0, a1, b0, b1, unnest(range(0, greatest(a1 - a0, b1 - b0))) AS i FROM bl),
    pr AS (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT p.id AS anon_id, a0 + i AS line, b0 + i AS place, CASE WHEN a0 + i < a1 THEN x[a0 + i] ELSE '' END AS s, CASE WHEN b0 + i < b1 THEN y[b0 + i] ELSE '' END AS m FROM pl p JOIN b USING (id))
        WHERE s <> m AND regexp_matches(m, '{_TAG}')),
    lt AS (SELECT *, string_split_regex(m, '{_TAG}') AS q, regexp_extract_all(m, '{_TAG}') AS tags FROM pr),
    fo AS (SELECT *, list_reduce(list_prepend({{'v': '', 'c': 0::BIGINT, 'lost': false, 'f': []::BIGINT[], 't': []::BIGINT[]}}, list_transform(q, lambda v: {{'v': v, 'c': 0::BIGINT, 'lost': false, 'f': []::BIGINT[], 't': []::BIGINT[]}})),
        lambda a, z: {{'v': z.v, 'c': CASE WHEN z.v = '' THEN a.c ELSE a.c + strpos(substr(s, a.c + 1), z.v) - 1 + length(z.v) END, 'lost': a.lost OR (z.v <> '' AND strpos(substr(s, a.c + 1), z.v) = 0),
            'f': list_append(a.f, CASE WHEN z.v <> '' THEN a.c + strpos(substr(s, a.c + 1), z.v) - 1 END), 't': list_append(a.t, CASE WHEN z.v <> '' THEN a.c + strpos(substr(s, a.c + 1), z.v) - 1 + length(z.v) END)}}) AS r FROM lt),
    op AS (SELECT *, list_filter(range(1, len(tags) + 1), lambda j: j = 1 OR q[j] <> '') AS opens FROM fo WHERE NOT r.lost),
    ru AS (SELECT *, unnest(range(1, len(opens) + 1)) AS n FROM op),
    an AS (SELECT id, anon_id, line, place, n - 1 AS part, tags[opens[n]:coalesce(opens[n + 1], len(tags) + 1) - 1] AS tags,
        substr(s, coalesce(r.t[opens[n]], 0) + 1, coalesce(r.f[coalesce(opens[n + 1], len(tags) + 1)], length(s)) - coalesce(r.t[opens[n]], 0)) AS region, false AS compared, false AS mixed FROM ru),
    lo AS (SELECT id, anon_id, line, place, {_TOKENS.format("s")} AS x, {_TOKENS.format("m")} AS y FROM fo WHERE r.lost), {_differing("tb", "lo")},
    bt AS (SELECT id, anon_id, line, place, a0, list_filter(y[b0:b1 - 1], lambda t: t IN ('[이름]', '[생년월일]', '[전화번호]')) AS tags, array_to_string(x[a0:a1 - 1], '') AS region, true AS compared, b1 - b0 AS size FROM tb JOIN lo USING (id)),
    cm AS (SELECT id, anon_id, line, place, row_number() OVER (PARTITION BY id ORDER BY a0) - 1 AS part, tags, region, compared, len(tags) < size AS mixed FROM bt WHERE len(tags) > 0),
    st AS (SELECT row_number() OVER () AS g, * REPLACE (trim(region, E' \\t\\n\\r') AS region) FROM (SELECT * FROM an UNION ALL SELECT * FROM cm)),
    rg AS (SELECT names, list_transform(list_distinct(list_transform(phone_numbers, lambda p: {_DIGITS.format("p")})), lambda d: array_to_string(string_split(d, ''), '[ \\t().-]*')) AS phones FROM registry),
    sv AS (SELECT g, tags, region FROM st WHERE len(tags) > 1 AND NOT mixed AND region <> ''),
    cu AS (SELECT g, tags, region, mode, 0::BIGINT AS c, []::VARCHAR[] AS vals FROM sv, (VALUES ('known'), ('shape')) k(mode) WHERE mode = 'shape' OR NOT list_contains(tags, '[생년월일]')
        UNION ALL
        SELECT g, tags, region, mode, e, list_append(vals, substr(region, c + 1, e - c)) FROM (
            SELECT *, unnest(CASE WHEN mode = 'shape' THEN range(c + 1, length(region) + 1)
                WHEN tags[len(vals) + 1] = '[이름]' THEN list_transform(list_filter(list_distinct(names), lambda w: starts_with(substr(region, c + 1), w)), lambda w: c + length(w))
                ELSE list_distinct(list_transform(list_filter(phones, lambda w: regexp_matches(substr(region, c + 1), '^' || w)), lambda w: c + length(regexp_extract(substr(region, c + 1), '^' || w)))) END) AS e
            FROM cu, rg WHERE len(vals) < len(tags))
        WHERE e <= length(region) AND (mode = 'known' OR ({_SHAPED.format(t="tags[len(vals) + 1]", v="substr(region, c + 1, e - c)")}))),
    wy AS (SELECT g, mode, count(DISTINCT vals) AS n, any_value(vals) AS vals FROM cu WHERE len(vals) = len(tags) AND c = length(region) GROUP BY g, mode),
    ct AS (SELECT g, coalesce(any_value(vals) FILTER (mode = 'known' AND n = 1), any_value(vals) FILTER (mode = 'shape' AND n = 1)) AS vals FROM wy GROUP BY g),
    vl AS (SELECT st.*, CASE WHEN len(tags) > 1 THEN ct.vals ELSE [region] END AS vals FROM st LEFT JOIN ct USING (g)),
    it AS (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM vl),
    ok AS (SELECT g, bool_and(({_SHAPED.format(t="tags[i]", v="vals[i]")}) AND vals[i] = trim(vals[i]) AND (tags[i] <> '[이름]' OR len(string_split_regex(trim(vals[i]), '\\s+')) = 1 OR len(list_filter(string_split_regex(trim(vals[i]), '\\s+'), lambda w: length(w) > 2)) = 0)) AS good FROM it GROUP BY g),
    rs AS (SELECT *, CASE WHEN mixed THEN 'unresolved_anchor_lost' WHEN region = '' AND (compared OR len(tags) = 1) THEN 'unresolved_empty' WHEN len(tags) > 1 AND (vals IS NULL OR (compared AND NOT coalesce(good, false))) THEN 'unresolved_adjacent'
        WHEN compared AND NOT coalesce(good, false) THEN 'unresolved_anchor_lost' END AS reason FROM it LEFT JOIN ok USING (g)),
    re AS (SELECT anon_id, line, place, part, i - 1 AS item, tags[i] AS tag, CASE WHEN reason IS NULL THEN vals[i] END AS value, reason FROM rs),
    redacted AS (SELECT * FROM re WHERE value IS NULL OR value NOT IN ('[이름]', '[생년월일]', '[전화번호]'))"""
_ENTRIES = f"""{_REDACTED},
    oe AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND line = lag(line) OVER w AND tag = lag(tag) OVER w AND value IS NOT DISTINCT FROM lag(value) OVER w AND reason IS NOT DISTINCT FROM lag(reason) OVER w THEN 0 ELSE 1 END AS o FROM redacted WINDOW w AS (PARTITION BY anon_id ORDER BY place, part, item)),
    ne AS (SELECT *, sum(o) OVER (PARTITION BY anon_id ORDER BY place, part, item ROWS UNBOUNDED PRECEDING) AS entry FROM oe),
    entries AS (SELECT anon_id, CAST(entry AS INT) AS entry, line, tag, CASE tag WHEN '[이름]' THEN 'name' WHEN '[생년월일]' THEN 'birthdate' ELSE 'phone' END AS type, value, value IS NOT NULL AS resolved, reason, count(*) AS count FROM ne GROUP BY ALL)"""


def _found_values(kind: str) -> str:
    # each value where it comes first; nulls as one value
    return f"list_transform(list_sort(list({{'e': e, 'v': value}}) FILTER (type = '{kind}')), lambda z: z.v)"


_RETRIED = f"""{_GAPS}, {_AUDIO}, {_RAW}, gn AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((e - s) / 20.0) AS BIGINT)))) AS i FROM gaps),
    gp AS (SELECT file, s + i * 20.0::DOUBLE AS s, least(s + (i + 1) * 20.0::DOUBLE, e) AS e FROM gn),
    gw AS (SELECT file, s AS ms, e AS me, greatest(0.0::DOUBLE, s - 0.5) AS cs, least(e + 0.5, coalesce(audio_seconds, e + 0.5)) AS ce FROM gp LEFT JOIN audio USING (file) WHERE s < e),
    heard AS (SELECT w.file, ms, me, cs, ce, r.s - cs AS s, r.e - cs AS e, text FROM gw w JOIN spoken r ON r.file = w.file AND r.s < ce AND r.e > cs WHERE r.s IS NOT NULL AND r.e IS NOT NULL),
    inside AS (SELECT file, ms, me, cs, s + cs AS s, least(e, ce - cs) + cs AS e, text FROM heard WHERE s < ce - cs AND least(e, ce - cs) > s),
    centred AS (SELECT * FROM inside WHERE (s + e) / 2 BETWEEN ms AND me)"""
_PICKED = f"""{_CHUNKS}, {_NUMBERED},
    lbl AS (SELECT file, label, '화자' || row_number() OVER (PARTITION BY file ORDER BY min({{'s': s, 'e': e, 'l': label}})) AS name FROM tn GROUP BY file, label),
    nl AS (SELECT nt.file, s, e, name AS label, row_number() OVER (PARTITION BY nt.file ORDER BY s, e, name) AS turn FROM nt JOIN lbl USING (file, label)),
    ov AS (SELECT c.file, c.pos, list_prepend({{'t': 0::BIGINT, 'o': 0.0::DOUBLE, 'r': 0.0::DOUBLE, 'l': NULL::VARCHAR}}, list({{'t': n.turn, 'o': least(c.e, n.e) - greatest(c.s, n.s), 'r': n.e - c.e, 'l': n.label}} ORDER BY n.turn)) AS l
        FROM chunks c JOIN nl n ON c.file = n.file AND least(c.e, n.e) - greatest(c.s, n.s) > 0 GROUP BY c.file, c.pos),
    best AS (SELECT file, pos, list_reduce(l, lambda a, x: CASE WHEN a.l IS NULL OR x.o > a.o + 0.05::DOUBLE OR (NOT (x.o < a.o - 0.05::DOUBLE) AND x.r > a.r) THEN x ELSE a END).l AS label FROM ov),
    mid AS (SELECT c.file, c.pos, min_by(n.label, {{'d': CASE WHEN (c.s + c.e) / 2 BETWEEN n.s AND n.e THEN 0.0 ELSE least(abs((c.s + c.e) / 2 - n.s), abs((c.s + c.e) / 2 - n.e)) END, 't': n.turn}}) AS label
        FROM chunks c JOIN nl n USING (file) GROUP BY c.file, c.pos),
    pk AS (SELECT c.file, c.pos, c.s, c.e, c.text, coalesce(b.label, m.label, '화자미상') AS speaker FROM chunks c LEFT JOIN best b USING (file, pos) LEFT JOIN mid m USING (file, pos)),
    pb AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND speaker IS NOT DISTINCT FROM lag(speaker) OVER w THEN 0 ELSE 1 END AS c FROM pk WINDOW w AS (PARTITION BY file ORDER BY pos)),
    pn AS (SELECT *, sum(c) OVER (PARTITION BY file ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM pb),
    pg AS (SELECT file, run, count(*) AS n, arg_min(s, pos) AS s, arg_max(e, pos) AS e, any_value(speaker) AS sp FROM pn GROUP BY file, run),
    pv AS (SELECT file, run, lag(sp) OVER w AS other, coalesce(lag(run) OVER w IS NOT NULL AND lead(run) OVER w IS NOT NULL AND lag(sp) OVER w IS NOT DISTINCT FROM lead(sp) OVER w AND n <= 2 AND e - s <= 0.8::DOUBLE
        AND s - lag(e) OVER w <= 0.05::DOUBLE AND lead(s) OVER w - e <= 0.05::DOUBLE, false) AS fits FROM pg WINDOW w AS (PARTITION BY file ORDER BY run)),
    sm AS (SELECT file, pos, s, e, text, CASE WHEN fits THEN other ELSE speaker END AS speaker FROM pn JOIN pv USING (file, run))"""


def _json_list(name: str) -> str:
    return f"""CASE WHEN len(info.{name}) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform(info.{name}, lambda v: '      ' || coalesce(CAST(to_json(v) AS VARCHAR), 'null')), ',' || chr(10)) || chr(10) || '    ]' END"""


ORACLES = {
    "p5_found": """
        WITH v AS (
            SELECT 'turns' AS origin, file, label, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM turns
            UNION ALL
            SELECT 'stt_timestamps', file, '', CAST(round(c.start * 1000) AS BIGINT), CAST(round(c."end" * 1000) AS BIGINT)
            FROM (SELECT file, unnest(chunks) AS c FROM stt_timestamps)
        ), m AS (
            SELECT *, max(e) OVER (PARTITION BY origin, file, label ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
            FROM (SELECT DISTINCT * FROM v WHERE s IS NOT NULL AND e IS NOT NULL AND e > s)
        ), i AS (
            SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY origin, file, label ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m
        ), p AS (
            SELECT origin, file, label, island, min(s) AS start_ms, max(e) AS end_ms FROM i GROUP BY ALL
        ), g AS (
            SELECT origin, file, label, end_ms AS start_ms, lead(start_ms) OVER (PARTITION BY origin, file, label ORDER BY island) AS end_ms FROM p
        )
        SELECT origin, file, label, 'period' AS kind, start_ms, end_ms FROM p
        UNION ALL
        SELECT origin, file, label, 'gap', start_ms, end_ms FROM g WHERE end_ms IS NOT NULL
    """,
    "interval_union": f"""WITH {_TURNS}, {_union("tn", "u", 0.1)} SELECT file, s AS start, e AS "end" FROM u""",
    "interval_union_keep_empty": f"""WITH {_TURNS}, {_union("tn", "u", 0.1, True)} SELECT file, s AS start, e AS "end" FROM u""",
    "interval_union_sorted": f"""WITH {_TURNS}, {_union("tn", "u", 0.1)} SELECT file, s AS start, e AS "end" FROM u""",
    "word_coverage": f"""WITH {_CHUNKS}, wide AS (SELECT file, greatest(0.0::DOUBLE, s - 0.15::DOUBLE) AS s, e + 0.15::DOUBLE AS e FROM chunks), {_union("wide", "u", 0.05)} SELECT file, round(s, 6) AS start, round(e, 6) AS "end" FROM u""",
    "speech_gaps": f"""WITH {_GAPS} SELECT file, round(s, 6) AS start, round(e, 6) AS "end" FROM gaps""",
    "split_gaps": f"""WITH {_TURNS}, w AS (SELECT file, label, min(s) AS s, max(e) AS e FROM tn GROUP BY file, label),
        n AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((e - s) / 2.0) AS BIGINT)))) AS i FROM w WHERE e > s)
        SELECT file, label, round(s + i * 2.0::DOUBLE, 6) AS start, round(least(s + (i + 1) * 2.0::DOUBLE, e), 6) AS "end" FROM n WHERE s + i * 2.0::DOUBLE < e""",
    "split_gaps_20": f"""WITH {_GAPS}, n AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((e - s) / 20.0) AS BIGINT)))) AS i FROM gaps)
        SELECT file, round(s + i * 20.0::DOUBLE, 6) AS start, round(least(s + (i + 1) * 20.0::DOUBLE, e), 6) AS "end" FROM n WHERE s + i * 20.0::DOUBLE < e""",
    "retry_windows": f"""WITH {_GAPS}, {_AUDIO}, n AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((e - s) / 20.0) AS BIGINT)))) AS i FROM gaps),
        p AS (SELECT file, s + i * 20.0::DOUBLE AS s, least(s + (i + 1) * 20.0::DOUBLE, e) AS e FROM n)
        SELECT file, round(s, 6) AS missing_start, round(e, 6) AS missing_end, round(greatest(0.0::DOUBLE, s - 0.5), 6) AS crop_start, round(least(e + 0.5, coalesce(audio_seconds, e + 0.5)), 6) AS crop_end
        FROM p LEFT JOIN audio USING (file) WHERE s < e""",
    "normalize_null_times": f"""WITH {_FILL} SELECT file, pos, s AS start, e AS "end" FROM filled""",
    "repair_timeline": f"""WITH {_RAW}, given AS (SELECT * FROM spoken WHERE s IS NOT NULL AND e IS NOT NULL), {_repair("given")} SELECT file, pos, round(s, 6) AS start, round(e, 6) AS "end", reset FROM repaired""",
    "prepared_chunks": f"""WITH {_FILL}, {_repair("filled")} SELECT file, count(*) AS chunks, count(*) FILTER (reset) AS resets, round(max(e), 6) AS transcript_end FROM repaired GROUP BY file""",
    "coverage_report": f"""WITH {_CHUNKS}, {_AUDIO}, ends AS (SELECT file, max(e) AS t FROM chunks GROUP BY file),
        r AS (SELECT file, coalesce(t, 0.0) AS t, audio_seconds AS a, CASE WHEN audio_seconds > 0 THEN coalesce(t, 0.0) / audio_seconds END AS ratio FROM audio LEFT JOIN ends USING (file))
        SELECT file, t AS transcript_end, a AS audio_seconds, round(ratio, 6) AS ratio, coalesce(ratio < 0.9::DOUBLE, false) AS short_transcript, CASE WHEN ratio < 0.9::DOUBLE THEN 'missing end' END AS cause FROM r""",
    "timeline_mismatch": f"""WITH {_CHUNKS}, {_TURNS}, a AS (SELECT file, max(e) AS t FROM chunks GROUP BY file), b AS (SELECT file, max(e) AS u FROM tn GROUP BY file)
        SELECT file, t AS transcript_end, u AS speech_end, coalesce(CASE WHEN u > 0 THEN t / u END < 0.9::DOUBLE, false) AS mismatch FROM a JOIN b USING (file)""",
    "label_speakers": f"""WITH {_TURNS}, f AS (SELECT file, label, min({{'s': s, 'e': e, 'l': label}}) AS m FROM tn GROUP BY file, label)
        SELECT file, label, '화자' || row_number() OVER (PARTITION BY file ORDER BY m) AS speaker FROM f""",
    "speaker_count": f"WITH {_TURNS} SELECT file, count(DISTINCT label) AS speakers FROM tn GROUP BY file",
    "pick_speaker_tolerance": f"""WITH {_CHUNKS}, {_NUMBERED},
        ov AS (SELECT c.file, c.pos, list_prepend({{'t': 0::BIGINT, 'o': 0.0::DOUBLE, 'r': 0.0::DOUBLE, 'l': NULL::VARCHAR}}, list({{'t': n.turn, 'o': least(c.e, n.e) - greatest(c.s, n.s), 'r': n.e - c.e, 'l': n.label}} ORDER BY n.turn)) AS l
            FROM chunks c JOIN nt n ON c.file = n.file AND least(c.e, n.e) - greatest(c.s, n.s) > 0 GROUP BY c.file, c.pos),
        best AS (SELECT file, pos, list_reduce(l, lambda a, x: CASE WHEN a.l IS NULL OR x.o > a.o + 0.3::DOUBLE OR (NOT (x.o < a.o - 0.3::DOUBLE) AND x.r > a.r) THEN x ELSE a END).l AS label FROM ov),
        mid AS (SELECT c.file, c.pos, min_by(n.label, {{'d': CASE WHEN (c.s + c.e) / 2 BETWEEN n.s AND n.e THEN 0.0 ELSE least(abs((c.s + c.e) / 2 - n.s), abs((c.s + c.e) / 2 - n.e)) END, 't': n.turn}}) AS label
            FROM chunks c JOIN nt n USING (file) GROUP BY c.file, c.pos)
        SELECT c.file, c.pos, coalesce(b.label, m.label, '화자미상') AS speaker FROM chunks c LEFT JOIN best b USING (file, pos) LEFT JOIN mid m USING (file, pos)""",
    "pick_speaker_max": f"""WITH {_CHUNKS}, {_TURNS}, {_MS}, {_OVER} SELECT cm.file, cm.pos, b.l AS speaker, coalesce(b.o, 0) AS overlap_ms FROM cm LEFT JOIN ov USING (file, pos)""",
    "nearest_speaker": f"""WITH {_CHUNKS}, {_TURNS}, {_MS}, {_NEAR} SELECT cm.file, cm.pos, nr.label AS speaker FROM cm LEFT JOIN nr USING (file, pos)""",
    "mapped_words": f"""WITH {_CHUNKS}, {_TURNS}, {_MS}, {_OVER}, {_NEAR}
        SELECT cm.file, cm.pos, trim(text, ' ') AS word, CAST(round_even(s * 1.0, 0) AS BIGINT) AS start, e AS "end", 'pass1' AS source, b.l AS raw_speaker, coalesce(b.o, 0) AS overlap_ms, coalesce(b.l, nr.label) AS speaker
        FROM cm LEFT JOIN ov USING (file, pos) LEFT JOIN nr USING (file, pos) WHERE trim(text, ' ') <> ''""",
    "smooth_speakers": f"""WITH {_ASSIGNED},
        b AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND speaker IS NOT DISTINCT FROM lag(speaker) OVER w THEN 0 ELSE 1 END AS c FROM asg WINDOW w AS (PARTITION BY file ORDER BY pos)),
        r AS (SELECT *, sum(c) OVER (PARTITION BY file ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM b),
        g AS (SELECT file, run, count(*) AS n, arg_min(s, pos) AS s, arg_max(e, pos) AS e, any_value(speaker) AS sp FROM r GROUP BY file, run),
        v AS (SELECT file, run, lag(sp) OVER w AS other, coalesce(lag(run) OVER w IS NOT NULL AND lead(run) OVER w IS NOT NULL AND lag(sp) OVER w IS NOT DISTINCT FROM lead(sp) OVER w AND n <= 2 AND e - s <= 1.5
            AND s - lag(e) OVER w <= 0.5 AND lead(s) OVER w - e <= 0.5, false) AS fits FROM g WINDOW w AS (PARTITION BY file ORDER BY run))
        SELECT file, pos, CASE WHEN fits THEN other ELSE speaker END AS speaker, fits AS absorbed FROM r JOIN v USING (file, run)""",
    "plain_lines": f"""WITH {_ASSIGNED}, {_lines("asg", False)} SELECT file, line, s AS start, e AS "end", text FROM lines""",
    "speaker_lines": f"""WITH {_ASSIGNED}, {_lines("asg", True)} SELECT file, line, speaker, s AS start, e AS "end", text FROM lines""",
    "plain_text": f"""WITH {_ASSIGNED}, {_lines("asg", False)} SELECT file, string_agg(text, chr(10) ORDER BY line) || chr(10) AS text FROM lines GROUP BY file""",
    "speaker_turns": f"""WITH {_WT} SELECT file, turn, speaker, s AS start, e AS "end", words FROM wt""",
    "srt_cues": f"""WITH {_WT} SELECT file, turn AS cue, turn || chr(10) || {_clock("s")} || ' --> ' || {_clock("e")} || chr(10) || '[' || {_NAME} || '] ' || trim(words, ' ') || chr(10) || chr(10) AS text FROM wt""",
    "speaker_text": f"""WITH {_WT} SELECT file, string_agg({_NAME} || ': ' || trim(words, ' ') || chr(10), '' ORDER BY turn) AS text FROM wt WHERE trim(words, ' ') <> '' GROUP BY file""",
    "dedupe_recovered": f"""WITH {_FRESH} SELECT file, r.pos AS pos, r.s AS start, r.e AS "end" FROM kept""",
    "merged_recovered": f"""WITH {_FRESH}, k AS (SELECT file, count(*) AS n FROM kept GROUP BY file), c AS (SELECT file, count(*) AS n FROM chunks GROUP BY file)
        SELECT file, coalesce(k.n, 0) + coalesce(c.n, 0) AS words, coalesce(k.n, 0) AS recovered FROM k FULL JOIN c USING (file)""",
    "mask_known": f"""WITH {_TEXTS}, {_REG}, p AS (SELECT file, names, {_masked_phones("text")} AS t FROM texts, reg),
        m AS (SELECT file, list_reduce(list_prepend(t, list_transform(names, lambda q: q.v)), lambda acc, n: replace(acc, n, '[이름]')) AS t FROM p)
        SELECT file, md5(t) AS masked_md5, len(regexp_extract_all(t, '\\[이름\\]')) AS name_tags, len(regexp_extract_all(t, '\\[생년월일\\]')) AS birthdate_tags, len(regexp_extract_all(t, '\\[전화번호\\]')) AS phone_tags FROM m""",
    "mask_phones_spoken": f"""WITH {_REG}, d AS (SELECT DISTINCT file, text FROM diarization WHERE text IS NOT NULL), p AS (SELECT file, text, {_masked_phones("text")} AS t FROM d, reg),
        c AS (SELECT file, len(regexp_extract_all(t, '\\[전화번호\\]')) - len(regexp_extract_all(text, '\\[전화번호\\]')) AS masks FROM p)
        SELECT * FROM c WHERE masks > 0""",
    "redacted_lines": f"""WITH {_REDACTED} SELECT anon_id, CAST(line AS INT) AS line, CAST(place AS INT) AS place, CAST(part AS INT) AS part, CAST(item AS INT) AS item, tag, value, reason FROM redacted""",
    "redaction_entries": f"""WITH {_ENTRIES} SELECT anon_id, entry, CAST(line AS INT) AS line, tag, type, value, resolved, reason, count FROM entries""",
    "redaction_summary": f"""WITH {_ENTRIES} SELECT anon_id, count(*) AS entries, CAST(sum(count) AS BIGINT) AS total, CAST(sum(CASE WHEN resolved THEN 0 ELSE count END) AS BIGINT) AS unresolved FROM entries GROUP BY anon_id""",
    "info_document": f"""WITH {_ENTRIES}, fs AS (SELECT anon_id, type, value, min(entry) AS e FROM entries GROUP BY anon_id, type, value)
        SELECT anon_id, {{'name': coalesce({_found_values("name")}, []), 'birthdate': coalesce({_found_values("birthdate")}, []), 'phone': coalesce({_found_values("phone")}, [])}} AS info FROM fs GROUP BY anon_id""",
    "shape_check": f"""WITH v AS (SELECT DISTINCT * FROM (SELECT 'name' AS kind, unnest(info.name) AS value FROM anonymization_info UNION ALL SELECT 'birthdate', unnest(info.birthdate) FROM anonymization_info
            UNION ALL SELECT 'phone', unnest(info.phone) FROM anonymization_info) WHERE value IS NOT NULL),
        d AS (SELECT *, {_DIGITS.format("value")} AS digits FROM v),
        s AS (SELECT *, CASE kind WHEN 'phone' THEN length(digits) BETWEEN 7 AND 15 AND regexp_full_match(value, '\\+?[0-9][0-9 \\t().-]*[0-9]')
            WHEN 'birthdate' THEN length(value) <= 40 AND length(digits) >= 4 AND regexp_full_match(value, '[0-9][0-9년월일생 \\t./-]*[0-9일생]')
            ELSE value <> '' AND length(value) <= 20 AND digits = '' AND NOT regexp_matches(value, '[,.:;!?/()\\[\\]{{}}]') END AS shaped FROM d)
        SELECT kind, value, shaped, shaped AND value = trim(value) AND (kind <> 'name' OR len(string_split_regex(trim(value), '\\s+')) = 1 OR len(list_filter(string_split_regex(trim(value), '\\s+'), lambda p: length(p) > 2)) = 0) AS plausible, digits FROM s""",
    "line_tokens": f"""WITH l AS (SELECT anon_id, unnest({_LINES.format("text")}) AS line FROM anonymization WHERE text IS NOT NULL)
        SELECT anon_id, count(*) AS lines, sum(length(regexp_replace(line, '{_TAG}', '#', 'g'))) AS tokens FROM l GROUP BY anon_id""",
    "canonical_text": f"""WITH {_RAW} SELECT file, pos, lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS canonical FROM raw WHERE text IS NOT NULL""",
    "run_summary": f"WITH {_RESULTS} SELECT {_SUMMARY} FROM st",
    "stage_counts": f"""WITH {_RESULTS}, p AS (SELECT shard, {_SUMMARY} FROM st GROUP BY shard),
        k AS (SELECT sum(total) AS total, sum(succeeded) AS succeeded, sum(skipped) AS skipped, sum(failed) AS failed, sum(short_transcripts) AS short_transcripts FROM p WHERE coalesce(shard NOT IN (7, 9), true) AND shard IS NOT NULL),
        g AS (SELECT count(*) AS missing FROM p WHERE shard IN (7, 9) OR shard IS NULL)
        SELECT *, '전체 ' || total || '개, 성공 ' || succeeded || '개, 건너뜀 ' || skipped || '개, 실패 ' || failed || '개' || CASE WHEN short_transcripts > 0 THEN ', 뒷부분 누락 의심 ' || short_transcripts || '개' ELSE '' END
            || CASE WHEN missing > 0 THEN ' (샤드 ' || missing || '개의 집계를 읽지 못해 실제보다 적음)' ELSE '' END AS report FROM k, g""",
    "exit_severity": f"""WITH {_RESULTS}, p AS (SELECT shard, {_SUMMARY} FROM st GROUP BY shard), c AS (SELECT shard, CASE WHEN shard = 40 THEN -9 WHEN failed > 0 THEN 1 ELSE 0 END AS code FROM p),
        w AS (SELECT coalesce(arg_min(code, shard) FILTER (code NOT IN (0, 1, 2)), max(code), 0) AS code FROM c)
        SELECT code, CASE WHEN code IN (0, 1, 2) THEN code ELSE 2 END AS merged, CASE code WHEN 0 THEN '전부 성공' WHEN 1 THEN '일부 파일 실패' WHEN 2 THEN '폴더 또는 모델 경로 문제' ELSE '알 수 없는 오류(코드 ' || code || ')' END AS said FROM w""",
    "qc_totals": f"""WITH {_WT.split(", wm AS")[0]}, {_TURNS}, {_MS}, {_OVER}, {_NEAR},
        w AS (SELECT cm.file, cm.pos, s, e, b.l AS raw_speaker, coalesce(b.l, nr.label) AS speaker FROM cm LEFT JOIN ov USING (file, pos) LEFT JOIN nr USING (file, pos) WHERE trim(text, ' ') <> ''),
        o AS (SELECT *, CASE WHEN row_number() OVER v = 1 OR speaker IS DISTINCT FROM lag(speaker) OVER v OR s - lag(e) OVER v > 1000 THEN 1 ELSE 0 END AS opens FROM w WINDOW v AS (PARTITION BY file ORDER BY pos))
        SELECT count(DISTINCT file) AS files, count(*) AS total_words, count(*) FILTER (raw_speaker IS NULL) AS unassigned_words, 0 AS retry_words, sum(opens) AS turns, 100 * count(*) FILTER (raw_speaker IS NULL) / count(*) AS unassigned_percent FROM o""",
    "token_budget": """WITH g AS (SELECT doc_id, least(12288, greatest(128, n_chars + greatest(256, CAST(floor(n_chars * 0.5) AS BIGINT)))) AS m FROM documents WHERE n_chars IS NOT NULL)
        SELECT doc_id, m AS max_new_tokens, greatest(600.0, m * 10 / 20.0) AS max_seconds FROM g""",
    "sample_first_n": "SELECT source || '/' || doc_id AS file FROM documents WHERE source IS NOT NULL ORDER BY string_split(source || '/' || doc_id, '/') LIMIT 100",
    "shard_modulo": """WITH f AS (SELECT file, row_number() OVER (ORDER BY string_split(file, '/')) - 1 AS "index" FROM (SELECT DISTINCT file FROM stt_timestamps)) SELECT * FROM f WHERE "index" % 3 = 1""",
    "resume_antijoin": "SELECT DISTINCT file FROM text_files WHERE file NOT IN (SELECT file FROM anonymization WHERE text IS NOT NULL AND regexp_matches(text, '\\S'))",
    "timestamp_documents": f"""WITH {_CHUNKS}, {_AUDIO}, c AS (SELECT file, CAST(count(*) AS INT) AS chunks, max(e) AS transcript_end, min(CASE WHEN regexp_matches(coalesce(text, ''), '\\S') AND s IS NOT NULL THEN 1 ELSE 0 END) AS good FROM chunks GROUP BY file)
        SELECT file, chunks, transcript_end, coalesce(CASE WHEN audio_seconds > 0 THEN transcript_end / audio_seconds END < 0.9::DOUBLE, false) AS short_transcript FROM c JOIN audio USING (file) WHERE good = 1""",
    "recorded_short": "SELECT file, any_value(coverage.ratio) IS NOT NULL AND coalesce(any_value(coverage.short_transcript), false) AS short_transcript FROM stt_timestamps GROUP BY file",
    "clipped_words": f"""WITH {_RETRIED} SELECT file, round(s, 6) AS start, round(e, 6) AS "end", text, round(cs, 6) AS crop_start FROM inside""",
    "centred_words": f"""WITH {_RETRIED} SELECT file, round(s, 6) AS start, round(e, 6) AS "end", text, round(ms, 6) AS missing_start FROM centred""",
    "probable_words": f"""WITH {_RAW}, p AS (SELECT file, pos, s, least(e, 1e6) AS e, CASE WHEN pos % 5 <> 0 THEN (pos % 100) / 100.0::DOUBLE END AS probability FROM spoken WHERE s < 1e6 AND e IS NOT NULL)
        SELECT file, pos, s + 0.0 AS start, e AS "end", probability FROM p WHERE e > s AND (s + e) / 2 BETWEEN 5.0 AND 1e6 AND coalesce(probability >= 0.35::DOUBLE, true)""",
    "new_exact_words": f"""WITH {_FRESH.replace("lower(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS w", "text AS w")} SELECT file, r.pos AS pos, r.s AS start, r.e AS "end" FROM kept""",
    "recovered_counts": f"""WITH {_RETRIED}, fr AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY s, e, text) - 1 AS pos, s, e, lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS w, (s + e) / 2 AS m FROM centred),
        {_FRESH[_FRESH.index("og AS"):]}, k AS (SELECT file, count(*) AS n FROM kept GROUP BY file), c AS (SELECT file, count(*) AS n FROM chunks GROUP BY file)
        SELECT file, coalesce(k.n, 0) + coalesce(c.n, 0) AS words, coalesce(k.n, 0) + coalesce(c.n, 0) - 1 AS last_pos FROM k FULL JOIN c USING (file)""",
    "diarized_text": f"""WITH {_PICKED}, {_lines("sm", True)} SELECT file, string_agg(speaker || ': ' || text, chr(10) ORDER BY line) || chr(10) AS text FROM lines GROUP BY file""",
    "text_round_trip": f"WITH {_TEXTS} SELECT file, md5(text) AS text_md5, strlen(text) AS length FROM texts",
    "bad_encodings": f"WITH {_TEXTS} SELECT file, true AS utf8, false AS other FROM texts",
    "wav_lengths": f"WITH {_AUDIO} SELECT file, CASE WHEN round(audio_seconds * 1000) > 0 THEN round(audio_seconds * 1000) / 1000 END AS seconds FROM audio",
    "summary_round_trip": f"""WITH {_RESULTS}, p AS (SELECT shard, {_SUMMARY} FROM st GROUP BY shard)
        SELECT 'shard-' || shard AS file, CASE WHEN failed = 0 THEN total END AS total, CASE WHEN failed = 0 THEN succeeded END AS succeeded, CASE WHEN failed = 0 THEN skipped END AS skipped, CASE WHEN failed = 0 THEN failed END AS failed,
            CASE WHEN failed = 0 THEN short_transcripts END AS short_transcripts FROM p""",
    "state_after_run": """WITH z AS (SELECT file, len(any_value(chunks)) AS size FROM stt_timestamps GROUP BY file),
        o AS (SELECT file, size - size % 2 AS size, CASE WHEN size % 5 = 0 THEN 'open' ELSE 'complete' END AS status FROM z WHERE size % 3 <> 0), f AS (SELECT file, size FROM z WHERE size % 7 <> 0)
        SELECT file, size, status, 'old' AS coverage FROM o WHERE file NOT IN (SELECT file FROM f)
        UNION ALL SELECT f.file, f.size, 'complete', CASE WHEN o.size = f.size AND o.status = 'complete' THEN 'old' ELSE 'new' END FROM f LEFT JOIN o USING (file)""",
    "kept_results": f"WITH {_RESULTS} SELECT DISTINCT file FROM diarization WHERE file NOT IN (SELECT file FROM st WHERE status = 'failed')",
    "matched_results": "SELECT DISTINCT file, regexp_replace(file, '\\.[^./]*$', '') || '.txt' AS result, regexp_replace(file, '\\.[^./]*$', '') || '.txt' IN (SELECT file FROM diarization) AS found FROM stt_timestamps",
    "job_list": """WITH f AS (SELECT file, row_number() OVER (ORDER BY string_split(file, '/')) - 1 AS "index" FROM (SELECT DISTINCT file FROM stt_timestamps))
        SELECT "index", file, regexp_replace(file, '\\.[^./]*$', '') || '.json' AS output FROM f WHERE "index" % 3 = 1""",
    "output_collisions": """WITH f AS (SELECT file FROM stt_timestamps UNION SELECT file FROM text_files)
        SELECT regexp_replace(file, '\\.[^./]*$', '') AS output, string_agg(file, '|' ORDER BY file) AS files FROM f GROUP BY 1 HAVING count(*) > 1""",
    "shard_labels": """WITH t AS (SELECT DISTINCT regexp_extract(file, '^[^/]+') AS gpu FROM stt_timestamps), w AS (SELECT gpu, CAST(row_number() OVER (ORDER BY gpu, k) - 1 AS INT) AS shard FROM t, range(3) r(k)), n AS (SELECT count(*) AS n FROM w)
        SELECT shard, gpu, lpad(CAST(shard AS VARCHAR), CAST(length(CAST(n - 1 AS VARCHAR)) AS INT), '0') || '/' || n AS label FROM w, n""",
    "masking_errors": """SELECT doc_id, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]') THEN 'blank text'
        WHEN length(text) * 8 > 8192 THEN 'too long: ' || length(text) * 8 || ' of 8192 tokens' END AS error FROM documents""",
    "stop_reasons": """SELECT doc_id, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]') THEN 'blank result'
        WHEN n_chars % 11 IN (0, 2, 5) THEN NULL WHEN n_chars >= 700 THEN 'token-limit' ELSE 'time-limit' END AS reason FROM documents WHERE n_chars IS NOT NULL""",
    "prompts": f"""WITH {_TEXTS}, k AS (SELECT file, text, 'plain' AS kind, '일반 전사 텍스트' AS said FROM texts UNION ALL SELECT DISTINCT file, text, 'diarized', '화자 구분 텍스트' FROM diarization WHERE text IS NOT NULL)
        SELECT file, kind, md5(said || ': ' || text || ' [' || text || ']') AS prompt_md5 FROM k""",
    "progress_lines": "SELECT doc_id, md5(string_split(text, chr(13))[-1]) AS shown_md5 FROM documents WHERE text IS NOT NULL",
    "speech_status": f"""WITH {_TURNS}, v AS (SELECT DISTINCT file FROM tn WHERE e > s AND label <> 'SPEAKER_00')
        SELECT file, CASE WHEN file IN (SELECT file FROM v) THEN 'speech' ELSE 'vad_silence' END AS status FROM (SELECT DISTINCT file FROM stt_timestamps)""",
}
ORACLES["info_texts"] = f"""WITH d AS ({ORACLES["info_document"]})
    SELECT anon_id || '.txt' AS file, '{{' || chr(10) || '  "file": ' || CAST(to_json(anon_id || '.txt') AS VARCHAR) || ',' || chr(10) || '  "info": {{' || chr(10) || '    "name": ' || {_json_list("name")} || ',' || chr(10)
        || '    "birthdate": ' || {_json_list("birthdate")} || ',' || chr(10) || '    "phone": ' || {_json_list("phone")} || chr(10) || '  }}' || chr(10) || '}}' || chr(10) AS text FROM d"""
