"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL["op10_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS h
        FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) AS t(p)),
later AS (SELECT doc_id, p FROM
          (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS r FROM win)
          WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM later, range(20) AS t(i)),
word AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.p) AS s
         FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
         GROUP BY word.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words,
       (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

_ESCAPED = ("replace(replace(replace(coalesce(text, ''), '\\', '\\\\'), '</turn>', '<\\/turn>'), "
            "'### ', '#\\## ')")

SQL["op2_chat_format"] = f"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
x AS (SELECT *, row_number() OVER w - 1 AS i, coalesce(lag(role) OVER w, '') AS before FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
y AS (SELECT *, (before || '>' || role) NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
      AS bad FROM x)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(coalesce(text, ''))) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + 2 + length({_ESCAPED}) + 8)::BIGINT AS formatted_chars,
       (count(*) FILTER (bad) = 0) AS valid, (min(i) FILTER (bad))::INTEGER AS first_bad
FROM y GROUP BY conv_id
"""

SQL["op5_warc_index"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
q AS (SELECT *, strlen(body) AS b, sha1(body) AS d FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d, b) AS o FROM q)
SELECT page_id, b::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN b >= 1000 AND o <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN b >= 1000 AND o <> page_id THEN o END AS refers_to
FROM r
"""

# the hash groups are of `7:<doc_id>`; list slices of the lines give prefix, middle and suffix
SQL["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
                  regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
u AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
             array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x
"""
