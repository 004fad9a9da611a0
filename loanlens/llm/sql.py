"""DuckDB SQL for the results of the registered queries, written from their definitions."""

from __future__ import annotations

from loanlens.llm.chat import Settings as ChatSettings
from loanlens.llm.divergence import Settings as AuditSettings
from loanlens.llm.fingerprints import Settings as SketchSettings
from loanlens.llm.linededup import Settings as LineSettings
from loanlens.llm.mixing import Settings as MixSettings
from loanlens.llm.quality import Limits
from loanlens.llm.urls import DEFAULT, RULES

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return WORDS.format(text=f"coalesce({text}, '')")


def quality_ctes(docs: str = "documents", limits: Limits = Limits()) -> str:
    """CTEs up to ``judged``: one row per row of ``docs``, by ``rid``, its row number."""
    lengths = sorted({*limits.ngrams, limits.repeat_window})
    dup = ", ".join(f"coalesce(any_value(chars) FILTER (n = {n}), 0)::BIGINT AS dup_chars_{n}" for n in sorted(limits.ngrams))
    over = " OR ".join(f"100 * coalesce(dup_chars_{n}, 0) > {most} * word_chars" for n, most in limits.ngrams.items())
    return rf"""
    numbered AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
    worded AS (SELECT rid, {words('text')} AS ws FROM numbered),
    basic AS (
        SELECT rid, len(ws)::BIGINT AS n_words,
               coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
               length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
        FROM worded JOIN numbered USING (rid)),
    lines AS (
        SELECT rid, length(l) AS size, row_number() OVER (PARTITION BY rid, l ORDER BY k) AS nth
        FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k
              FROM numbered WHERE text IS NOT NULL)
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    line_sums AS (
        SELECT rid, count(*) FILTER (nth > 1)::BIGINT AS n_dup_lines, sum(size)::BIGINT AS line_chars,
               coalesce(sum(size) FILTER (nth > 1), 0)::BIGINT AS dup_line_chars
        FROM lines GROUP BY rid),
    lengths AS (SELECT unnest({lengths}) AS n),
    windows AS (
        SELECT rid, n, k, array_to_string(ws[k : k + n - 1], ' ') AS gram
        FROM (SELECT rid, n, ws, unnest(range(1, len(ws) - n + 2)) AS k FROM worded, lengths WHERE len(ws) >= n)),
    twice AS (SELECT rid, n, k FROM windows QUALIFY count(*) OVER (PARTITION BY rid, n, gram) > 1),
    inside AS (SELECT DISTINCT rid, n, unnest(range(k, k + n)) AS k FROM twice),
    covered AS (
        SELECT rid, n, count(*) AS n_inside, sum(length(ws[k]))::BIGINT AS chars
        FROM inside JOIN worded USING (rid) GROUP BY rid, n),
    shares AS (
        SELECT rid, coalesce(any_value(n_inside) FILTER (n = {limits.repeat_window}), 0)::BIGINT AS n_repeat_words, {dup}
        FROM covered GROUP BY rid),
    judged AS (
        SELECT rid, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars,
               {', '.join(f'coalesce(dup_chars_{n}, 0) AS dup_chars_{n}' for n in sorted(limits.ngrams))},
               n_words < {limits.min_words} OR 100 * coalesce(n_repeat_words, 0) > {limits.max_repeat} * n_words AS base_failed,
               NOT (n_words < {limits.min_words} OR 100 * coalesce(n_repeat_words, 0) > {limits.max_repeat} * n_words
                    OR 100 * coalesce(dup_line_chars, 0) > {limits.lines} * coalesce(line_chars, 0) OR {over}) AS kept
        FROM basic LEFT JOIN line_sums USING (rid) LEFT JOIN shares USING (rid))"""


def quality() -> str:
    return f"WITH {quality_ctes()} SELECT doc_id, j.* EXCLUDE (rid) FROM judged j JOIN numbered USING (rid)"


def jaccard_ctes(docs: str = "documents") -> str:
    """CTEs up to ``classes`` (doc_id, n_shingles, component_id)."""
    return rf"""
    WITH_SETS AS MATERIALIZED (
        SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
               ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k : k + 4], ' '))) END AS sh
        FROM (SELECT doc_id, {words(LOWERED.format(text='text'))} AS ws FROM {docs})),
    shingled AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS shingle FROM WITH_SETS),
    linked AS MATERIALIZED (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM shingled x JOIN shingled y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
             AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM WITH_SETS
        UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
    classes AS (
        SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(r.b) AS component_id
        FROM WITH_SETS s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.sh))""".replace("WITH_SETS", "sets")


def near_duplicates() -> str:
    return f"WITH RECURSIVE {jaccard_ctes()} SELECT * FROM classes"


def url_filters() -> str:
    found = " UNION ALL ".join(
        f"SELECT '{r.text}' AS rule, '{r.verdict}' AS verdict, {str(r.site).lower()} AS site" for r in RULES)
    return rf"""
    WITH rules AS ({found}),
    cut AS (SELECT row_number() OVER () AS rid, page_id,
                   CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS behind FROM pages),
    hosted AS (SELECT rid, page_id, regexp_extract(behind, '^[^/?#]*') AS raw_host, behind FROM cut),
    split AS (SELECT rid, page_id, {LOWERED.format(text='raw_host')} AS host,
                     regexp_extract(substr(behind, length(raw_host) + 1), '^[^?#]*') AS path,
                     substr(behind, length(raw_host) + 1) AS tail FROM hosted),
    fits AS (
        SELECT rid, rule, verdict, site FROM split, rules
        WHERE CASE WHEN site THEN (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                        AND starts_with(path, substr(rule, strpos(rule, '/')))
                   ELSE '.' || host || tail LIKE '%' || replace(replace(replace(rule, '\', '\\'), '_', '\_'), '*', '%') || '%' ESCAPE '\' END),
    best AS (
        SELECT rid, rule, verdict, site FROM fits
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY site DESC, length(rule) DESC, rule) = 1)
    SELECT page_id, host, path, CASE WHEN site THEN rule END AS rule, coalesce(verdict, '{DEFAULT}') AS verdict,
           CASE WHEN NOT site THEN rule END AS pattern
    FROM split LEFT JOIN best USING (rid)"""


def mixing_ctes(docs: str = "documents", s: MixSettings = MixSettings()) -> str:
    """CTEs up to ``mix`` (rid and the result's columns), one row per row of ``docs``, by row number ``rid``."""
    ctes, path, amount = [], [], f"(SELECT coalesce(sum(n_tokens), 0)::HUGEINT * {s.budget_percent} // 100 FROM mix_rows)"
    for level, weight in zip(["domain", "lang", "source"], s.weights, strict=True):
        up = f"u_{path[-1]}" if path else None
        parents = ", ".join(path)
        on = " AND ".join(f"n.{c} IS NOT DISTINCT FROM p.{c}" for c in path)
        family = f"PARTITION BY {parents}" if path else ""
        ctes.append(f"""
    n_{level} AS (SELECT {parents + ', ' if path else ''}{level}, sum(n_tokens)::HUGEINT AS tokens FROM mix_rows GROUP BY ALL),
    k_{level} AS (SELECT *, tokens * {s.most_epochs} AS capacity, ({weight})::HUGEINT AS weight FROM n_{level}),
    w_{level} AS (SELECT n.*, {'p.share' if path else amount} AS amount FROM k_{level} n {f'JOIN {up} p ON {on}' if path else ''}),
    h_{level} AS (SELECT *, CASE WHEN weight > 0 THEN capacity ELSE 0 END AS held FROM w_{level}),
    o_{level} AS (SELECT *, weight > 0 AND held * sum(weight) OVER (t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                  <= weight * (amount - coalesce(sum(held) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
                  FROM h_{level} WINDOW t AS ({family} ORDER BY CASE WHEN weight > 0 THEN capacity::DOUBLE / weight::DOUBLE END NULLS FIRST,
                                              {level} NULLS FIRST)),
    u_{level} AS (SELECT * EXCLUDE (weight, held, is_full), (CASE WHEN weight <= 0 THEN 0 WHEN is_full THEN held
                  ELSE weight * (amount - coalesce(sum(held) FILTER (is_full) OVER f, 0)) // sum(weight) FILTER (NOT is_full) OVER f END)::BIGINT AS share
                  FROM o_{level} WINDOW f AS ({family}))""")
        path.append(level)
    return rf"""
    mix_numbered AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
    mix_rows AS (
        SELECT rid, doc_id, {s.domain} AS domain, lang, source,
               len({words('text')})::BIGINT AS n_tokens
        FROM mix_numbered), {','.join(ctes)},
    leaf_plan AS (
        SELECT domain, lang, source, share AS quota, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS epochs,
               CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS part FROM u_source),
    placed AS (
        SELECT r.*, l.quota, l.epochs, l.part, md5('{s.seed}/' || l.epochs::BIGINT || '/' || coalesce(r.doc_id::VARCHAR, '')) AS place
        FROM mix_rows r JOIN leaf_plan l ON r.domain IS NOT DISTINCT FROM l.domain AND r.lang IS NOT DISTINCT FROM l.lang
             AND r.source IS NOT DISTINCT FROM l.source),
    mix AS (
        SELECT rid, doc_id, domain, lang, source, n_tokens, quota,
               (CASE WHEN n_tokens = 0 THEN 0 ELSE epochs + (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) <= part
                AND part > 0)::INT END)::INT AS copies
        FROM placed)"""


def source_mixing() -> str:
    return f"WITH {mixing_ctes()} SELECT * EXCLUDE (rid) FROM mix"


def chat_formatting(s: ChatSettings = ChatSettings()) -> str:
    narrators = ", ".join(f"'{x}'" for x in s.narrators)
    return rf"""
    WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS said FROM conversations),
    numbered AS (
        SELECT *, floor(turn / {s.part_turns}) AS stretch,
               row_number() OVER (PARTITION BY conv_id, floor(turn / {s.part_turns}) ORDER BY turn NULLS LAST, role, said) - 1 AS nth FROM turns),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role NOT IN ({narrators})),
    pieces AS (
        SELECT n.conv_id, speaker, stretch, nth // {s.part_turns} AS slice, nth, role = speaker AS own,
               '{s.begin}' || CASE WHEN role = speaker THEN 'assistant' WHEN role IN ({narrators}) THEN role
                              ELSE 'user name=' || role END || chr(10) AS head, said || '{s.end}' || chr(10) AS body
        FROM numbered n JOIN speakers p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
    placed AS (
        SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, stretch, slice ORDER BY nth) AS upto FROM pieces),
    parts AS (
        SELECT conv_id, speaker, stretch, slice, count(*)::INT AS n_turns, string_agg(head || body, '' ORDER BY nth) AS text,
               coalesce(string_agg((upto - length(body))::BIGINT || '-' || (upto - 1)::BIGINT, ',' ORDER BY nth) FILTER (own), '') AS loss_spans
        FROM placed GROUP BY conv_id, speaker, stretch, slice)
    SELECT conv_id, speaker, (row_number() OVER t - 1)::INT AS part, n_turns,
           coalesce(sum(length(text)) OVER (PARTITION BY conv_id, speaker ORDER BY stretch NULLS LAST, slice
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_char, text, loss_spans
    FROM parts WINDOW t AS (PARTITION BY conv_id, speaker ORDER BY stretch NULLS LAST, slice)"""


def line_ctes(docs: str = "documents", s: LineSettings = LineSettings()) -> str:
    """CTEs up to ``line_clean`` (rid, doc_id, dropped, clean), one row per row of ``docs``."""
    return rf"""
    line_docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {docs}),
    all_lines AS MATERIALIZED (
        SELECT rid, doc_id, k, l, ws, len(ws) AS m, array_to_string(ws, ' ') AS norm FROM (
            SELECT rid, doc_id, l, k, {words('l')} AS ws FROM (
                SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS l,
                       generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM line_docs WHERE text IS NOT NULL))),
    firsts AS MATERIALIZED (
        SELECT norm, any_value(ws) AS ws, any_value(m) AS m,
               min((doc_id IS NULL, doc_id, k)) AS place FROM all_lines WHERE m > 0 GROUP BY norm),
    without AS MATERIALIZED (
        SELECT norm, place, m, i, array_to_string(list_concat(ws[1 : i - 1], ws[i + 1 : m]), ' ') AS rest
        FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM firsts WHERE m >= {s.min_words})),
    near AS (
        SELECT x.norm, y.place FROM without x JOIN without y ON x.m = y.m AND x.i = y.i AND x.rest = y.rest AND y.place < x.place
        UNION ALL
        SELECT x.norm, y.place FROM without x JOIN firsts y ON x.rest = y.norm AND y.m >= {s.min_words} AND y.place < x.place
        UNION ALL
        SELECT x.norm, y.place FROM firsts x JOIN without y ON x.norm = y.rest AND x.m >= {s.min_words} AND y.place < x.place
        UNION ALL
        SELECT norm, place FROM firsts),
    earliest AS (SELECT norm, min(place) AS place FROM near GROUP BY norm),
    judged_lines AS (
        SELECT a.rid, a.k, a.l, coalesce(e.place < (a.doc_id IS NULL, a.doc_id, a.k), false) AS gone
        FROM all_lines a LEFT JOIN earliest e ON a.norm = e.norm AND a.m > 0),
    line_clean AS (
        SELECT d.rid, d.doc_id, coalesce(g.dropped, []) AS dropped, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.clean, '') END AS clean
        FROM line_docs d LEFT JOIN (
            SELECT rid, list(k ORDER BY k) FILTER (gone) AS dropped, string_agg(l, chr(10) ORDER BY k) FILTER (NOT gone) AS clean
            FROM judged_lines GROUP BY rid) g USING (rid))"""


def line_dedup() -> str:
    return rf"""
    WITH {line_ctes()}
    SELECT doc_id, len(dropped)::BIGINT AS n_dropped, array_to_string(dropped, ',') AS dropped_lines,
           length(clean)::BIGINT AS clean_chars, md5(clean) AS clean_md5 FROM line_clean"""


def source_divergence(s: AuditSettings = AuditSettings()) -> str:
    p = f"1 + {s.unit}::HUGEINT * (coalesce({{n}}, 0) + 1) // ({{total}} + v)"
    return rf"""
    WITH rows_of AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    found AS (
        SELECT rid, lang, source, unnest(regexp_extract_all({LOWERED.format(text='text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows_of),
    kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT rid) >= {s.min_docs}),
    uses AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (
        SELECT lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total
        FROM (SELECT DISTINCT lang FROM rows_of) LEFT JOIN kept k USING (lang) GROUP BY lang),
    sources AS (
        SELECT g.lang, g.source, any_value(l.v) AS v, coalesce(sum(u.n), 0) AS total, any_value(l.total) AS lang_total
        FROM (SELECT DISTINCT lang, source FROM rows_of) g JOIN langs l USING (lang)
        LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source GROUP BY g.lang, g.source),
    weights AS (
        SELECT s.lang, s.source, k.term, coalesce(u.n, 0) AS n, {p.format(n='u.n', total='s.total')} AS p, {p.format(n='k.n', total='s.lang_total')} AS q
        FROM sources s JOIN kept k USING (lang) LEFT JOIN uses u ON u.lang = s.lang AND u.source = s.source AND u.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    valued AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM weights WHERE n > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM valued
    QUALIFY part = 'pair' OR rank <= {s.top_terms}"""


def document_fingerprints(s: SketchSettings = SketchSettings()) -> str:
    sketch = (f"CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < {s.shingle} THEN [md5(array_to_string(ws, ' '))[1:16]] "
              f"ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - {s.shingle - 2}), "
              f"lambda i: md5(array_to_string(ws[i : i + {s.shingle - 1}], ' '))[1:16])))[1:{s.k}] END")
    union = "list_sort(list_distinct(list_concat({x}, {y})))[1:%d]" % s.k
    near = f"CASE WHEN len(own) + len({{y}}) = 0 THEN 1.0 ELSE len(list_intersect({union.format(x='own', y='{y}')}, list_intersect(own, {{y}})))::DOUBLE / len({union.format(x='own', y='{y}')}) END"
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    nexts AS (
        SELECT rid, doc_id, text, coalesce(lead(text) OVER t, first_value(text) OVER t) AS following,
               coalesce(lead(rid) OVER t, first_value(rid) OVER t) AS next_rid
        FROM docs WINDOW t AS (ORDER BY doc_id DESC NULLS LAST, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    changed AS (
        SELECT *, substr(text, 1, (length(text) - length(text) // 2)::INT) || substr(following, 1, (length(text) // 2)::INT) AS edited_text FROM nexts),
    own AS MATERIALIZED (SELECT rid, {sketch} AS own FROM (SELECT rid, {words('text')} AS ws FROM docs)),
    edits AS MATERIALIZED (SELECT rid, {sketch} AS edited FROM (SELECT rid, {words('edited_text')} AS ws FROM changed)),
    sketched AS (
        SELECT c.*, o.own, e.edited, n.own AS after
        FROM changed c JOIN own o USING (rid) JOIN edits e USING (rid) JOIN own n ON n.rid = c.next_rid),
    held AS (SELECT *, list_intersect({union.format(x='own', y='edited')}, own) AS mine FROM sketched)
    SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited_text) AS edited_sha256,
           array_to_string(own, '') AS fingerprint, array_to_string(edited, '') AS edited_fingerprint,
           {near.format(y='edited')} AS near_edited, {near.format(y='after')} AS near_next,
           CASE WHEN len(own) = 0 THEN 1.0 WHEN len(mine) = 0 THEN 0.0 ELSE len(list_intersect(mine, edited))::DOUBLE / len(mine) END AS kept_share,
           CASE WHEN len(own) < {s.k} THEN len(own)
                ELSE floor({float((s.k - 1) << 48)}::DOUBLE / (('0x' || own[{s.k}][1:12])::BIGINT::DOUBLE + 1.0))::BIGINT END AS distinct_shingles
    FROM held"""
