"""DuckDB SQL for the results of the queries that SQL can express."""

from __future__ import annotations

from starloom.llm import rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _rule(r: rules.Rule) -> str:
    value = f"CAST({r.metric} AS DOUBLE)"
    return " AND ".join(f"{value} {sign} {bound}" for sign, bound in ((">=", r.low), ("<=", r.high)) if bound is not None)


_STOP = ", ".join(f"'{w}'" for w in sorted({*rules.STOP_WORDS}))

QUALITY_RULES = rf"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents
    ), places AS (
      SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d
    ), windows AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM places
    ), covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY doc_id
    ), figures AS (
      SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_intersect(list_distinct(list_transform(ws, lambda x: lower(x))), [{_STOP}])) AS BIGINT) AS n_stop_words,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN covered USING (doc_id)
    ), judged AS (
      SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM figures
    )
    SELECT *, CASE WHEN base_failed THEN false ELSE {" AND ".join(_rule(r) for r in rules.RULES)} END AS kept FROM judged
"""

SUBSTRING_DEDUP = rf"""
    WITH d AS (
      SELECT doc_id, {_WORDS} AS ws FROM documents
    ), starts AS (
      SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d
    ), windows AS (
      SELECT doc_id, s, md5(array_to_string(list_slice(ws, s, s + 49), ' ')) AS w FROM starts
    ), repeated AS (
      SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY w) AS first_id FROM windows) WHERE first_id < doc_id
    ), places AS (
      SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS s FROM d
    ), marked AS (
      SELECT doc_id, s, word,
             max(CASE WHEN repeated.s IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone
      FROM places LEFT JOIN repeated USING (doc_id, s)
    ), kept AS (
      SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY s) FILTER (NOT gone) AS words
      FROM marked GROUP BY doc_id
    )
    SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
"""

WARC = """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
    ), k AS (
      SELECT digest, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest
    )
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
    FROM p LEFT JOIN k USING (digest)
"""

MIXING = rf"""
    WITH d AS (
      SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
      FROM documents
    ), s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
    ), w AS (
      SELECT *, 2 * source_size AS cap, [5, 2, 1][(place - 1) % 3 + 1] AS weight, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s
    ), filling AS (  -- sources in the order in which they come to their caps
      SELECT *, (budget - coalesce(sum(cap) OVER before, 0)::DOUBLE) / (sum(weight) OVER rest)::DOUBLE AS share, row_number() OVER (ORDER BY cap / weight, place) AS step
      FROM w WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    rest AS (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ), final AS (
      SELECT arg_min(share, step) AS share FROM filling WHERE share * weight <= cap
    ), t AS (
      SELECT source, source_size, least(final.share * weight, cap::DOUBLE) AS target FROM w, final
    ), full_copies AS (
      SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS full_n FROM t
    ), placed AS (
      SELECT d.*, f.source_size, f.target, f.full_n, f.target - f.full_n * f.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN full_copies f ON d.source IS NOT DISTINCT FROM f.source
    )
    SELECT doc_id, source, size, source_size, target,
           CAST(CASE WHEN size > 0 THEN least(full_n + CASE WHEN (2 * before + size)::DOUBLE <= 2 * rest THEN 1 ELSE 0 END, 2) ELSE 0 END AS BIGINT) AS copies,
           CAST(copies * size AS BIGINT) AS taken
    FROM placed
"""

_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda i: i)),
                                          lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""

CONVERSATION_REPAIR = rf"""
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
      FROM conversations
    ), sums AS (
      SELECT *, xor({_CRC}, 4294967295) % 20 AS f FROM keyed
    ), damaged AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN f = 0 THEN 0 WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
      FROM sums
    ), ordered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
      FROM damaged
    ), judged AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
             lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS last_role
      FROM ordered
    ), counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (last_role IS NOT NULL AND left(last_role, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
      FROM judged GROUP BY conv_id
    ), moves AS (  -- from state to state (0 nothing yet, 1 after s, 2 after u, 3 after a) by Keep, Rerole, Delete
      SELECT * FROM (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')) t(a, b, initial)
    ), edits AS (
      SELECT conv_id, i, a, b, CASE WHEN left(role, 1) = initial THEN 'K' ELSE 'R' END AS edit,
             CASE WHEN left(role, 1) = initial THEN 0 ELSE 1 END + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS price,
             [CASE WHEN left(role, 1) = initial THEN role WHEN b = 2 THEN 'user' ELSE 'assistant' END || ':' || text] AS kept
      FROM judged, moves WHERE fault NOT IN ('blank', 'duplicate') AND (left(role, 1) = initial OR initial <> 's')
      UNION ALL
      SELECT conv_id, i, s, s, 'D', 2, CAST([] AS VARCHAR[]) FROM judged, range(4) r(s)
    ), inserts AS (  -- up to two user or assistant rows before a row, or at the end
      SELECT * FROM (VALUES (0, 0, '', 0, CAST([] AS VARCHAR[])), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
        (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
        (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])) t(a, b, edit, price, kept)
    ), best AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS kept FROM counted
      UNION ALL
      SELECT conv_id, i, state, x.cost, x.audit, x.kept FROM (
        SELECT p.conv_id, e.i, e.b AS state,
               min(struct_pack(cost := p.cost + n.price + e.price, audit := p.audit || n.edit || e.edit, kept := list_concat(p.kept, n.kept, e.kept))) AS x
        FROM best p JOIN inserts n ON n.a = p.state JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.a = n.b
        GROUP BY p.conv_id, e.i, e.b)
    ), ends AS (
      SELECT p.conv_id, min(struct_pack(cost := p.cost + n.price, audit := p.audit || n.edit, kept := list_concat(p.kept, n.kept))) AS x
      FROM best p JOIN inserts n ON n.a = p.state AND n.b IN (0, 3)
      JOIN (SELECT conv_id, max(i) AS i FROM judged GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.i = p.i
      GROUP BY p.conv_id
    )
    SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost, coalesce(x.audit, '') AS audit,
           sha256(coalesce(array_to_string(x.kept, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE = {
    "op5_quality_rules": QUALITY_RULES,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op10_warc": WARC,
    "op11_mixing": MIXING,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
