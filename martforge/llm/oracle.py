"""DuckDB SQL of the registered queries that SQL can express."""

_CALLS = """
u AS (SELECT DISTINCT conv_id, turn, text, length(text) AS n, CAST(to_json(text) AS VARCHAR) AS q
      FROM conversations WHERE role = 'user' AND text IS NOT NULL),
c0 AS (SELECT conv_id, turn, 'call_' || turn AS call_id, n,
       CASE WHEN n % 13 = 0 THEN 'lookup' WHEN n % 3 = 0 THEN 'search' WHEN n % 3 = 1 THEN 'translate' ELSE 'count' END AS name,
       CASE WHEN n % 3 = 0 THEN '{"filters":{"a":[true,null,{"b":-2,"y":"x"}],"z":1},"limit":'
                 || CASE WHEN n % 5 = 0 THEN '"' || (n % 50) || '"' ELSE CAST(n % 50 AS VARCHAR) END
                 || CASE WHEN n % 7 = 0 THEN '' ELSE ',"query":' || q END || '}'
            WHEN n % 3 = 1 THEN '{' || CASE WHEN n % 7 = 0 THEN '' ELSE '"text":' || q || ',' END
                 || '"to":"de"' || CASE WHEN n % 4 = 0 THEN ',"tone":"x"' ELSE '' END || '}'
            ELSE '{"strict":false,"text":' || CASE WHEN n % 8 = 0 THEN '7' ELSE q END || ',"words":[3,1,"x"]}' END AS body,
       CASE WHEN n % 9 = 0 THEN turn + 2 WHEN n % 2 = 0 AND turn >= 2 THEN turn - 2 END AS needs
      FROM u),
c1 AS (SELECT conv_id, turn, call_id, n, name, needs,
       CASE WHEN n % 11 = 0 THEN NULL ELSE body END AS arguments,
       CASE WHEN n % 11 = 0 THEN ['json'] WHEN n % 13 = 0 THEN ['tool']
            WHEN n % 3 = 0 THEN list_concat(CASE WHEN n % 7 = 0 THEN ['missing:query'] ELSE [] END, CASE WHEN n % 5 = 0 THEN ['type:limit'] ELSE [] END)
            WHEN n % 3 = 1 THEN list_concat(CASE WHEN n % 7 = 0 THEN ['missing:text'] ELSE [] END,
                                            CASE WHEN n % 4 = 0 THEN ['unknown:tone'] ELSE [] END)
            ELSE CASE WHEN n % 8 = 0 THEN ['type:text'] ELSE [] END END AS faults
       FROM c0),
c AS (SELECT c1.*, row_number() OVER (PARTITION BY conv_id, turn ORDER BY name, arguments NULLS FIRST, faults, needs) AS pick FROM c1),
f AS (SELECT * FROM c WHERE pick = 1 AND conv_id IS NOT NULL),
e AS (SELECT a.conv_id, a.turn, a.needs, b.turn AS there FROM f a LEFT JOIN f b ON a.conv_id = b.conv_id AND a.needs = b.turn WHERE a.needs IS NOT NULL),
odd AS (SELECT DISTINCT conv_id FROM e WHERE there >= turn),
w AS (SELECT f.conv_id, f.turn, 1 AS wave FROM f JOIN odd USING (conv_id)
      WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.conv_id = f.conv_id AND e.turn = f.turn AND e.there IS NOT NULL)
      UNION ALL SELECT e.conv_id, e.turn, w.wave + 1 FROM w JOIN e ON e.conv_id = w.conv_id AND e.there = w.turn),
r AS (SELECT conv_id, 'call_' || (turn - 1) AS call_id, turn, text FROM conversations WHERE role = 'assistant'),
r1 AS (SELECT conv_id, call_id, min(turn) AS result_turn, min(text) AS content FROM r GROUP BY ALL),
l AS (SELECT f.*, list_sort(list_concat(faults, CASE WHEN e.turn IS NOT NULL AND e.there IS NULL THEN ['after:call_' || e.needs] ELSE [] END)) AS errs,
             CASE WHEN odd.conv_id IS NULL THEN 0 ELSE w.wave END AS wave, r1.result_turn, r1.content
      FROM f LEFT JOIN e ON e.conv_id = f.conv_id AND e.turn = f.turn LEFT JOIN odd ON odd.conv_id = f.conv_id
      LEFT JOIN w ON w.conv_id = f.conv_id AND w.turn = f.turn LEFT JOIN r1 ON r1.conv_id = f.conv_id AND r1.call_id = f.call_id)
"""

OP2 = f"""
WITH RECURSIVE {_CALLS}
SELECT conv_id, turn, CAST(0 AS INTEGER) AS call_index, call_id, name,
       CASE WHEN len(errs) > 0 THEN 'invalid' WHEN wave IS NULL THEN 'cycle' WHEN result_turn IS NULL THEN 'no_result' ELSE 'ok' END AS status,
       array_to_string(errs, ',') AS errors, arguments, result_turn, CAST(wave AS INTEGER) AS wave,
       '{{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || call_id || '","name":"' || name || '","result":'
           || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}}' AS message
FROM l
UNION ALL
SELECT conv_id, turn, 0, call_id, name, 'duplicate', array_to_string(list_sort(faults), ','), arguments, NULL, NULL, NULL
FROM c WHERE pick > 1
UNION ALL
SELECT DISTINCT r.conv_id, r.turn, NULL, r.call_id, NULL, 'orphan', '', NULL, r.turn, NULL,
       '{{"id":"' || r.call_id || '","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}}'
FROM r WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.conv_id = r.conv_id AND f.call_id = r.call_id)
"""

OP11 = r"""
WITH t AS (SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
m AS (SELECT t.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      list_filter([CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
                   CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 5 * length(t.text) THEN 'C' END,
                   CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' END, CASE WHEN first < t.doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS fails
      FROM t JOIN firsts ON firsts.text = t.text LEFT JOIN marks ON marks.doc_id = t.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM l a, l b, l c, l d, l e
           WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT o, step, substr(o, step, 1) AS f, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: instr(o, x) < step) AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
s AS (SELECT part, o, step, f,
      sum(CASE WHEN NOT list_has_any(fails, before) AND NOT list_contains(fails, f) THEN n ELSE 0 END) AS kept,
      sum(CASE WHEN NOT list_has_any(fails, before) AND list_contains(fails, f) THEN n ELSE 0 END) AS removed,
      sum(CASE WHEN list_has_any(fails, before) AND list_contains(fails, f) THEN n ELSE 0 END) AS redundant,
      sum(CASE WHEN fails = [f] THEN n ELSE 0 END) AS unique_fails,
      sum(CASE WHEN NOT list_has_any(fails, before) AND list_contains(fails, f) THEN good ELSE 0 END) AS good_lost,
      sum(CASE WHEN NOT list_has_any(fails, before) AND list_contains(fails, f) THEN toxic ELSE 0 END) AS toxic_lost
      FROM cells, steps GROUP BY part, o, step, f)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM s
"""

OP13 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
v AS (SELECT DISTINCT term FROM b),
c AS (SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
      FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) SEMI JOIN v USING (term) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM c GROUP BY term),
x AS (SELECT r, doc_id, term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS points
      FROM c JOIN df USING (term), g),
s AS (SELECT item_id, r, doc_id, CAST(sum(points) AS BIGINT) AS score FROM x JOIN b USING (term) GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""

SQL: dict[str, str] = {"op2_tool_calls": OP2, "op11_filter_audit": OP11, "op13_ranked_search": OP13}
