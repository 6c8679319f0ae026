"""DuckDB SQL with the rows of the queries that SQL can express."""

from __future__ import annotations

from . import leakage, repetition

_SPACE = r"\s\x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# labels are matched with the space before them, twice, as two of them may share one
_COMPACT = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]', '', 'g')".format(
    f"regexp_replace(regexp_replace(text, '(?i)(^|[{_SPACE}]){leakage.LABEL}[{_SPACE}]?[:：]', '\\1 ', 'g'), '(?i)(^|[{_SPACE}]){leakage.LABEL}[{_SPACE}]?[:：]', '\\1 ', 'g')"
)

_WS = r"\s\x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _parts(name: str, split: str) -> str:
    """The share of characters in parts of a text that stood in it before."""
    return f"""{name}_p AS (SELECT id, unnest(list_transform({split}, lambda q: regexp_replace(q, '^[{_WS}]+|[{_WS}]+$', '', 'g'))) AS q FROM t WHERE text IS NOT NULL),
        {name}_c AS (SELECT id, q, count(*) AS n FROM {name}_p GROUP BY id, q),
        {name} AS (SELECT id, CASE WHEN sum(length(q) * n) > 0 THEN sum(length(q) * (n - 1)) / sum(length(q) * n) ELSE 0.0 END AS share FROM {name}_c GROUP BY id)"""


def _grams(name: str, n: int) -> str:
    """The share of characters in runs of n words that stood in the text before."""
    return f"""{name}_g AS (SELECT id, i, w[i:i + {n - 1}] AS g FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w)),
        {name}_o AS (SELECT id, i, row_number() OVER (PARTITION BY id, g ORDER BY i) AS k FROM {name}_g),
        {name}_c AS (SELECT DISTINCT id, unnest(range(i, i + {n})) AS i FROM {name}_o WHERE k > 1),
        {name}_s AS (SELECT c.id, sum(length(w[c.i])) AS n FROM {name}_c c JOIN w USING (id) GROUP BY c.id),
        {name} AS (SELECT id, coalesce(n, 0) / greatest(1, list_sum(list_transform(w, lambda q: length(q)))) AS share FROM w LEFT JOIN {name}_s USING (id))"""


_LEDGER = f"""t AS (SELECT row_number() OVER () AS id, file, text FROM text_files),
        w AS (SELECT id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE text IS NOT NULL),
        z AS (SELECT id, array_to_string(w, '') AS s FROM w),
        g AS (SELECT id, s, unnest(range(1, length(s) - 10)) AS i FROM z WHERE length(s) > 12),
        f AS (SELECT id, i, min(i) OVER (PARTITION BY id, substr(s, i, 12)) AS first FROM g),
        c AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + 12)) AS p FROM f WHERE i > first) GROUP BY id),
        span AS (SELECT id, coalesce(n, 0) / greatest(1, length(s)) AS share FROM z LEFT JOIN c USING (id)),
        {_parts("line", "string_split_regex(text, '[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]')")},
        {_parts("sentence", f"string_split_regex(regexp_replace(text, '([.?!…])[{_WS}]+', '\\1' || chr(1), 'g'), chr(1) || '|[\\r\\n]+')")},
        {_parts("paragraph", f"string_split_regex(text, '(?:\\r\\n|\\r|\\n)[{_WS}]*(?:\\r\\n|\\r|\\n)')")},
        word AS (SELECT id, CASE WHEN len(w) >= 20 THEN list_max(list_transform(list_distinct(w), lambda q: len(list_filter(w, lambda v: v = q)))) / len(w) ELSE 0.0 END AS share FROM w),
        {_grams("bigram", 2)}, {_grams("quintuple", 5)},
        m AS (SELECT t.file, span.share AS span, line.share AS line, sentence.share AS sentence, paragraph.share AS paragraph, word.share AS word, bigram.share AS bigram, quintuple.share AS quintuple
            FROM t LEFT JOIN span USING (id) LEFT JOIN line USING (id) LEFT JOIN sentence USING (id) LEFT JOIN paragraph USING (id) LEFT JOIN word USING (id) LEFT JOIN bigram USING (id) LEFT JOIN quintuple USING (id))"""


def _bits(**over: float) -> str:
    """The failure bits of the rules named, or of all, at their base thresholds or others."""
    base = dict(zip(repetition.RULES, repetition.THRESHOLDS))
    return " + ".join(f"CASE WHEN {r} >= {over.get(r) or base[r]}::DOUBLE THEN {1 << i} ELSE 0 END" for i, r in enumerate(base) if not over or r in over)


_POLICY_BITS = [(p, _bits(**{r: p.over.get(r, dict(zip(repetition.RULES, repetition.THRESHOLDS))[r]) for r in p.rules})) for p in repetition.POLICIES]
_JUDGED = "j AS (" + " UNION ALL ".join(f"SELECT file, '{p.name}' AS policy, {p.version} AS version, {p.mask} AS mask, {bits} AS bits FROM m" for p, bits in _POLICY_BITS) + ")"

ORACLES = {
    "p1_ledger": f"""WITH {_LEDGER} SELECT file, {", ".join(f"{r} AS {r}_share" for r in repetition.RULES)}, {_bits()} AS failed FROM m""",
    "p1_policies": f"""WITH {_LEDGER}, {_JUDGED} SELECT file, policy, version, bits FROM j WHERE bits <> 0""",
    "p1_ablation": f"""WITH {_LEDGER}, {_JUDGED}, r AS (SELECT * FROM (VALUES {", ".join(f"('{r}', {1 << i})" for i, r in enumerate(repetition.RULES))}) v(rule, bit))
        SELECT policy, version, rule, CAST(count(*) AS BIGINT) AS rows, count(*) FILTER (bits <> 0) AS failing, count(*) FILTER (bits & bit <> 0) AS by_rule, count(*) FILTER (bits = bit) AS only_by_rule,
               coalesce(bit_or(bits) FILTER (bits & bit <> 0), 0) AS fails_with
        FROM j, r WHERE mask & bit <> 0 GROUP BY policy, version, rule""",
    "p1_found": r"""
        WITH t AS (
            SELECT DISTINCT file, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS s FROM text_files WHERE text IS NOT NULL
        ), g AS (
            SELECT file, s, unnest(range(1, length(s) - 10)) AS i FROM t WHERE length(s) > 12
        ), f AS (
            SELECT file, s, i, min(i) OVER (PARTITION BY file, s, substr(s, i, 12)) AS first FROM g
        ), c AS (
            SELECT file, s, count(DISTINCT p) AS repeated FROM (SELECT file, s, unnest(range(i, i + 12)) AS p FROM f WHERE i > first) GROUP BY file, s
        )
        SELECT DISTINCT file FROM c WHERE repeated >= 0.3 * length(s)
    """,
    "p3_found": r"""
        SELECT DISTINCT origin, file,
               CASE WHEN regexp_matches(text, '[^\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}.?!…]{1000}[^\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}.?!…]')
                    THEN 'forced' ELSE 'natural' END AS cut
        FROM (SELECT 'text_files' AS origin, file, text FROM text_files UNION ALL SELECT 'diarization', file, text FROM diarization)
        WHERE length(text) > 1000
    """,
    "p3_pieces": r"""
        WITH RECURSIVE t AS (
            SELECT row_number() OVER () AS id, origin, file, text, length(text) AS n
            FROM (SELECT 'text_files' AS origin, file, text FROM text_files UNION ALL SELECT 'diarization', file, text FROM diarization) WHERE length(text) > 1000
        ), c AS (
            SELECT id, text, n, -1::BIGINT AS piece, 0::BIGINT AS back1, 0::BIGINT AS lo, 0::BIGINT AS hi FROM t
            UNION ALL
            SELECT id, text, n, piece + 1, lo, hi, hi + CASE
                WHEN piece >= 0 AND n - hi <= 950 THEN n - hi
                ELSE coalesce(
                    list_max(list_filter(range(half + 1, most + 1), lambda k: regexp_matches(w[k], '[\n\r\x{85}\x{2028}\x{2029}]'))),
                    list_max(list_filter(range(half + 1, most + 1), lambda k: regexp_matches(w[k:k + 1], '^[.?!…][SPACE]$'))),
                    list_max(list_filter(range(half + 1, most + 1), lambda k: regexp_matches(w[k], '[SPACE]'))),
                    list_max(list_filter(range(half + 1, most + 1), lambda k: regexp_matches(w[k], '[.?!…]'))),
                    list_max(list_filter(range(least, half + 1), lambda k: regexp_matches(w[k], '[SPACE.?!…]'))),
                    least(most, length(w))) END
            FROM (SELECT *, CASE WHEN piece < 0 THEN 1000 ELSE 950 END AS most, CASE WHEN piece < 0 THEN 500 ELSE 475 END AS half, CASE WHEN piece < 0 THEN 50 ELSE 1 END AS least,
                         substr(text, hi + 1, CASE WHEN piece < 0 THEN 1001 ELSE 951 END) AS w FROM c WHERE hi < n)
        ), b AS (
            SELECT *, substr(text, lo + 1, hi - lo) AS core, lag(back1, 1, 0) OVER (PARTITION BY id ORDER BY piece) AS back2 FROM c WHERE piece >= 0
        ), f AS (
            SELECT *, CASE WHEN piece = 0 THEN '' ELSE substr(text, lo - least(150, 1000 - (hi - lo), lo - back2) + 1, least(150, 1000 - (hi - lo), lo - back2)) END AS before FROM b
        ), o AS (
            SELECT *, coalesce(length(before) + 1 - list_min(list_filter(range(2, length(before) - 48), lambda k: NOT regexp_matches(before[k], '[SPACE]') AND regexp_matches(before[k - 1], '[SPACE]'))), length(before)) AS overlap FROM f
        )
        SELECT origin, file, CAST(piece AS INT) AS piece, CAST(lo - overlap AS INT) AS start, CAST(hi AS INT) AS "end",
               CASE WHEN hi = o.n THEN 'end' WHEN regexp_matches(core[-1], '[\n\r\x{85}\x{2028}\x{2029}]') THEN 'line' WHEN regexp_matches(core, '[.?!…][SPACE]*$') THEN 'sentence' WHEN regexp_matches(core[-1], '[SPACE]') THEN 'word' ELSE 'character' END AS boundary,
               CAST(overlap AS INT) AS overlap, CAST(hi - lo + overlap AS INT) AS size
        FROM o JOIN t USING (id)
    """.replace("SPACE", r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"),
    "p8_in_full": f"""
        WITH d AS (SELECT doc_id, {_COMPACT} AS t FROM documents WHERE text IS NOT NULL), i AS (SELECT DISTINCT item_id, {_COMPACT} AS t FROM eval_items WHERE text IS NOT NULL)
        SELECT DISTINCT doc_id, item_id FROM d JOIN i ON contains(d.t, i.t) WHERE i.t <> ''
    """,
    "p9_found": """
        WITH g AS (
            SELECT DISTINCT doc_id, substr(text, i, 250) AS span FROM (SELECT doc_id, text, unnest(range(1, length(text) - 248)) AS i FROM documents WHERE length(text) >= 250)
        ), s AS (
            SELECT span FROM g GROUP BY span HAVING count(*) > 1
        ), k AS (
            SELECT g.* FROM g SEMI JOIN s USING (span)
        )
        SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM k a JOIN k b ON a.span = b.span AND a.doc_id < b.doc_id
    """,
    "p9_shares": """
        WITH c AS (
            SELECT min(doc_id) AS rep, count(DISTINCT doc_id) AS copies, text FROM documents WHERE length(text) >= 250 GROUP BY text
        ), g AS (
            SELECT rep, i, substr(text, i, 250) AS span FROM (SELECT rep, text, unnest(range(1, length(text) - 248)) AS i FROM c)
        ), s AS (
            SELECT span FROM g GROUP BY span HAVING count(DISTINCT rep) > 1
        ), k AS (
            SELECT g.* FROM g SEMI JOIN s USING (span)
        ), u AS (
            SELECT rep, least(250, coalesce(lead(i) OVER (PARTITION BY rep ORDER BY i) - i, 250)) AS own FROM k
        ), v AS (
            SELECT rep, sum(own) AS covered FROM u GROUP BY rep
        ), d AS (
            SELECT DISTINCT rep, span FROM k
        ), l AS (
            SELECT a.rep, count(DISTINCT b.rep) AS links FROM d a JOIN d b ON a.span = b.span AND a.rep <> b.rep GROUP BY a.rep
        )
        SELECT c.rep, copies, coalesce(links, 0) AS links, CAST(CASE WHEN copies > 1 THEN length(text) ELSE covered END AS BIGINT) AS shared_chars, length(text) AS n_chars,
               CASE WHEN copies > 1 THEN length(text) ELSE covered END / length(text) AS share
        FROM c LEFT JOIN v USING (rep) LEFT JOIN l USING (rep) WHERE copies > 1 OR covered IS NOT NULL
    """,
}
