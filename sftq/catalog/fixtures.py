"""Test records composed from the driver's tables.

Each text runs unchanged in Spark and DuckDB (``$name`` marks a table). Backslash and
quote are written as ``chr(92)`` and ``chr(39)``, as the dialects escape literals
differently. ``expect_*`` columns are for the oracles; queries do not read them.
"""

from __future__ import annotations


def json_escaped(text: str) -> str:
    """SQL for the inside of a JSON, TOML or double-quoted YAML string."""
    return (
        f"replace(replace(replace({text}, chr(92), chr(92) || chr(92)), "
        f"'\"', chr(92) || '\"'), chr(10), chr(92) || 'n')"
    )


# Payloads in five formats around the whole document text, one in eleven broken.
SFT_PAYLOADS = f"""
SELECT doc_id, source, lang, text, fmt, broken, id, n,
  CASE WHEN doc_id % 7 <> 0 THEN fmt WHEN fmt = 'JSON' THEN ' json ' WHEN fmt = 'YAML' THEN 'yml'
       WHEN fmt = 'TOML' THEN 'C_TOML' WHEN fmt = 'XML' THEN 'c_xml' ELSE 'tsv' END AS label,
  CASE fmt
   WHEN 'JSON' THEN '{{"doc_id": ' || id || ', "lang": "' || lang || '", "text": "' || esc || '"' || CASE WHEN broken THEN '' ELSE '}}' END
   WHEN 'YAML' THEN 'doc_id: ' || id || chr(10) || 'lang: ' || lang || chr(10) || 'meta:' || chr(10) || CASE WHEN broken THEN '   ' ELSE '  ' END || 'text: "' || esc || '"'
   WHEN 'TOML' THEN 'doc_id = ' || id || chr(10) || 'lang = ' || CASE WHEN broken THEN lang ELSE '"' || lang || '"' END || chr(10) || 'text = "' || esc || '"' || chr(10) || 'pt = {{ x = ' || n || ', y = 2 }}' || chr(10) || '[[meta.row]]' || chr(10) || 'n = ' || n || chr(10) || '[meta.row.sub]' || chr(10) || 'j = "[1, 2]"'
   WHEN 'XML' THEN '<doc id="' || id || '"><lang>' || lang || '</lang><text>' || replace(replace(text, '&', '&amp;'), '<', '&lt;') || '</text>' || CASE WHEN broken THEN '' ELSE '</doc>' END
   ELSE CASE WHEN doc_id % 2 = 0 THEN 'doc_id,lang,text' || chr(10) || id || ',' || lang || ',"' || replace(text, '"', '""') || '"'
             ELSE 'doc_id,line' || chr(10) || id || ',' || replace(replace(replace(text, ',', ';'), '"', ''), chr(10), chr(10) || id || ',') || '.' END
        || CASE WHEN broken THEN ',x' ELSE '' END
  END AS payload
FROM (SELECT doc_id, source, lang, text, {json_escaped('text')} AS esc, CAST(doc_id AS STRING) AS id, CAST(n_chars AS STRING) AS n, doc_id % 11 = 0 AS broken,
        CASE doc_id % 5 WHEN 0 THEN 'JSON' WHEN 1 THEN 'YAML' WHEN 2 THEN 'TOML' WHEN 3 THEN 'XML' ELSE 'CSV' END AS fmt
      FROM $documents) a
"""

# The payload as a model would hand it over: bare, after a marker, in a fence, in the last fence.
SFT_RECORDS = """
SELECT doc_id AS record_id, source AS dataset, lang, label AS output_format, fmt AS expect_format, NOT broken AS expect_ok,
  'Return ONLY ' || fmt || ' for: ' || text AS prompt, payload AS expect_payload,
  CASE doc_id % 4
    WHEN 0 THEN payload
    WHEN 1 THEN 'Approach: ' || text || chr(10) || chr(10) || 'Output:' || chr(10) || payload
    WHEN 2 THEN 'Done. ' || text || chr(10) || '```' || lower(fmt) || chr(10) || payload || chr(10) || '```'
    ELSE '```text' || chr(10) || text || chr(10) || '```' || chr(10) || 'noise' || chr(10) || '```' || chr(10) || payload || chr(10) || '```' || chr(10)
  END AS output
FROM $sft_payloads p
"""

# Records as JSON text in five shapes.
RAW_RECORDS = f"""
SELECT record_id, record_id % 5 AS shape, prompt AS expect_prompt, output AS expect_output, output_format AS expect_label,
  '{{"record_id": ' || CAST(record_id AS STRING) || ', "output_format": "' || output_format || '", ' ||
  CASE record_id % 5
    WHEN 0 THEN '"metadata": {{"prompt": "' || p || '", "output": "' || o || '"}}'
    WHEN 1 THEN '"messages": [{{"role": "user", "content": "first"}}, {{"role": "user", "content": "' || p || '"}}, {{"role": "assistant", "content": "' || o || '"}}]'
    WHEN 2 THEN '"metadata": {{"prompt": "' || p || '"}}, "messages": [{{"role": "assistant", "content": "' || o || '"}}, {{"role": "assistant", "content": null}}]'
    WHEN 3 THEN '"metadata": {{"prompt": null, "output": "' || o || '"}}, "messages": []'
    ELSE '"category": "C_JSON", "subcategory": "x", "messages": "' || p || '"'
  END || '}}' AS raw
FROM (SELECT record_id, output_format, prompt, output, {json_escaped('prompt')} AS p, {json_escaped('output')} AS o FROM $sft_records r) e
"""

# Audit records as JSON text: plain, bundled (with one metadata entry too many) and by category.
AUDIT_RAW = f"""
SELECT dataset, CAST(substr(dataset, 4) AS INT) AS dataset_pos, 'train' AS split, record_id AS i,
  CASE record_id % 3
    WHEN 0 THEN '{{"metadata": {{"format": "' || output_format || '", "type": "' || kind || '", "schema": "s_' || lang || '"}}, "messages": ' || chat || '}}'
    WHEN 1 THEN '{{"metadata": [{{"format": "' || output_format || '", "type": "' || kind || '", "schema": "s_' || lang || '"}}, {{"format": "json", "type": "pair"}}, {{"format": "xml"}}], "messages": [' || chat || ', [{{"role": "assistant", "content": "{{' || chr(92) || '"a' || chr(92) || '": 1}}"}}]]}}'
    ELSE '{{"category": "C_' || expect_format || '", "subcategory": "' || CASE WHEN record_id % 2 = 0 THEN 'text_to_' || lower(expect_format) || ' ' ELSE 'plain' END || '", "task": ' || CASE WHEN record_id % 4 = 0 THEN '"transform"' ELSE 'null' END || ', "messages": ' || chat || '}}'
  END AS raw
FROM (SELECT *, CASE WHEN record_id % 5 = 0 THEN '' ELSE 'generation' END AS kind,
        '[{{"role": "user", "content": "' || {json_escaped('prompt')} || '"}}, {{"role": "assistant", "content": "' || {json_escaped('output')} || '"}}]' AS chat
      FROM $sft_records r) e
"""

# What the audit should find in them. The reasons are the parsers' own messages.
AUDIT_EXPECTED = """
SELECT dataset, CAST(substr(dataset, 4) AS INT) AS dataset_pos, 'train' AS split, record_id AS i, j, record_id * 1048576 + coalesce(j, 0) AS pos,
  CAST(record_id AS STRING) || coalesce(':' || CAST(j AS STRING), '') AS idx, family, output_format, task_kind, task_schema,
  family || '|' || output_format || '|' || task_kind || '|' || task_schema AS task_key, payload, usable,
  CASE WHEN usable THEN 'ok' WHEN output_format = 'YAML' THEN 'yaml_indent_fail' ELSE 'parse_fail: ' || CASE output_format
    WHEN 'JSON' THEN 'Expecting ' || chr(39) || ',' || chr(39) || ' delimiter: line 1 column ' || CAST(length(payload) + 1 AS STRING) || ' (char ' || CAST(length(payload) AS STRING) || ')'
    WHEN 'TOML' THEN 'Invalid value (at line 2, column 8)'
    WHEN 'XML' THEN 'no element found: line ' || CAST(1 + length(payload) - length(replace(payload, chr(10), '')) AS STRING) || ', column ' || CAST(length(element_at_last) AS STRING)
    ELSE CASE WHEN record_id % 2 = 0 THEN 'row 2 width mismatch: 4 != 3'
         ELSE 'row ' || CAST(1 + length(payload) - length(replace(payload, chr(10), '')) AS STRING) || ' width mismatch: 3 != 2' END
  END END AS reason
FROM (
 SELECT dataset, record_id, CASE WHEN record_id % 3 = 1 THEN 0 END AS j, CASE WHEN record_id % 3 = 2 THEN 'daichira' ELSE 'u10bei' END AS family,
  expect_format AS output_format,
  CASE WHEN record_id % 3 = 2 THEN CASE WHEN record_id % 4 = 0 THEN 'transform' ELSE 'unknown' END WHEN record_id % 5 = 0 THEN 'unknown' ELSE 'generation' END AS task_kind,
  CASE WHEN record_id % 3 <> 2 THEN 's_' || lang WHEN record_id % 2 = 0 THEN 'text_to_' || lower(expect_format) ELSE 'plain' END AS task_schema,
  expect_payload AS payload, regexp_replace(expect_payload, '^(.*' || chr(10) || ')*', '') AS element_at_last, expect_ok AS usable
 FROM $sft_records r
 UNION ALL
 SELECT dataset, record_id, 1, 'u10bei', 'JSON', 'pair', 'unknown', '{"a": 1}', '', true FROM $sft_records r WHERE record_id % 3 = 1
) m
"""

# Three attempts per label: failed call, empty reply, non-JSON, prose around JSON, odd types.
JUDGE_ATTEMPTS = """
SELECT l.doc_id AS record_id, a.attempt AS attempt,
  NOT (a.attempt = 0 AND l.doc_id % 6 = 0) AS ok,
  CASE WHEN a.attempt = 0 AND l.doc_id % 6 = 0 THEN 'url_error: refused' END AS error,
  CASE WHEN a.attempt = 0 AND l.doc_id % 6 = 1 THEN 'load' ELSE 'stop' END AS done_reason,
  CASE WHEN a.attempt = 0 AND l.doc_id % 6 IN (0, 1) THEN ''
       WHEN a.attempt = 0 AND l.doc_id % 6 = 2 THEN 'I would say 80'
       WHEN l.doc_id % 6 = 3 THEN 'Sure: {"usable": "false", "score": "90", "rationale_en": "text flag"}'
       WHEN l.doc_id % 6 = 4 THEN '{"usable": true, "score": 250, "rationale_en": "too high"}'
       WHEN l.doc_id % 12 = 5 THEN '{"usable": true, "rationale_en": "no score"}'
       ELSE '{"usable": ' || CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'true' ELSE 'false' END
            || ', "score": ' || CAST(60 + 30 * l.quality + l.doc_id % 10 AS STRING) || ', "rationale_en": "ok"}' END AS text
FROM $labels l CROSS JOIN (VALUES (0), (1), (2)) AS a(attempt)
"""

# Scored records: odd labels, missing judgements, scores as numbers and as text.
SFT_SCORED = """
SELECT record_id, rel_path, line_no, output_format, usable, score_text,
  '{"output_format": ' || CASE WHEN output_format IS NULL THEN 'null' ELSE '"' || output_format || '"' END ||
  CASE WHEN usable IS NULL THEN '' ELSE ', "evaluation": {"usable": ' || CASE WHEN usable THEN 'true' ELSE 'false' END || ', "llm": {"score": ' ||
    CASE WHEN record_id % 2 = 1 OR score_text = 'n/a' OR record_id % 10 = 0 THEN '"' || score_text || '"' ELSE score_text END || '}}' END || '}' AS raw
FROM (
SELECT d.doc_id AS record_id, 'set_' || CAST(d.doc_id % 3 AS STRING) || CASE WHEN d.doc_id % 2 = 0 THEN '/shard_' ELSE '-b/shard_' END || CAST(d.doc_id % 8 AS STRING) AS rel_path, d.doc_id AS line_no, d.source,
 CASE d.doc_id % 9 WHEN 0 THEN 'json' WHEN 1 THEN ' YAML ' WHEN 2 THEN 'yml' WHEN 3 THEN 'C_JSON' WHEN 4 THEN 'CSV' WHEN 5 THEN 'toml' WHEN 6 THEN 'XML' WHEN 7 THEN '' ELSE CAST(NULL AS STRING) END AS output_format,
 CASE l.quality WHEN 1 THEN true WHEN 0 THEN false END AS usable,
 CASE WHEN l.doc_id IS NULL THEN NULL WHEN d.doc_id % 10 = 0 THEN '87.5' WHEN d.doc_id % 10 = 1 THEN 'n/a' ELSE CAST(55 + 35 * l.quality + d.doc_id % 10 AS STRING) END AS score_text
FROM $documents d LEFT JOIN $labels l ON d.doc_id = l.doc_id) s
"""

# Texts rich in escapes: whole pages as XML, whole documents in the other formats.
ESCAPE_TEXTS = f"""
SELECT record_id, dataset, fmt AS output_format, record_id % 3 <> 0 AS usable, text FROM (
 SELECT page_id AS record_id, 'pages' AS dataset, 'XML' AS fmt, html || '<![CDATA[x]]>&#65;&#x41;&lt;' AS text FROM $pages
 UNION ALL
 SELECT doc_id, source, CASE doc_id % 5 WHEN 0 THEN 'JSON' WHEN 1 THEN 'TOML' WHEN 2 THEN 'YAML' WHEN 3 THEN 'CSV' ELSE 'INI' END,
  CASE doc_id % 5
   WHEN 0 THEN '{{"p": "C:' || chr(92) || chr(92) || 'd' || chr(92) || '"q' || chr(92) || '/' || chr(92) || 'n' || repeat(chr(92) || 't', CAST(doc_id % 6 AS INT)) || chr(92) || 'u00e9' || {json_escaped('text')} || '"' || chr(10) || '}}'
   WHEN 1 THEN 'p = "a' || chr(92) || 'n' || repeat(chr(92) || '"', CAST(doc_id % 5 AS INT)) || {json_escaped('text')} || '"' || chr(10) || 'in = [ {{ a = 1 }}, {{ b = "}}" }} ]' || chr(10) || 'k = {{ c = {{ d = 1 }} }}'
   WHEN 2 THEN 'p: "a' || chr(92) || 'x41' || chr(92) || 't' || {json_escaped('text')} || '"' || chr(10) || 'q: ' || chr(39) || 'it' || chr(39) || chr(39) || 's' || chr(39)
   ELSE 'a,b' || chr(10) || '"x' || chr(10) || 'y","say "' || '"' || lang || ': ' || replace(text, '"', '""') || '""' || '"'
  END FROM $documents) u
"""

# TOML whose headers and inline tables vary with the document; its text is one string in it.
TOML_VARIED = f"""
SELECT doc_id AS record_id, tables, arrays, name, child, items, nested,
  'doc = "' || {json_escaped('text')} || '"' || chr(10) || repeat('[t.a]' || chr(10) || 'k = 1' || chr(10), tables)
  || repeat(' [[ ' || name || ' ]]' || chr(10), arrays) || CASE WHEN child THEN '[' || name || '.c]  ' || chr(10) ELSE '' END
  || repeat('x = [ {{ y = 2 }}, {{ z = "}}" }} ]' || chr(10), items) || repeat('k = {{ a = {{ b = 1 }} }}' || chr(10), nested) AS text
FROM (SELECT doc_id, text, CAST(doc_id % 4 AS INT) AS tables, CAST(doc_id % 3 AS INT) AS arrays,
 CASE WHEN doc_id % 2 = 0 THEN 'r' ELSE 'r.q' END AS name, doc_id % 5 < 2 AS child,
 CAST(doc_id % 7 AS INT) AS items, CAST(doc_id % 11 AS INT) AS nested FROM $documents d) v
"""

FIXTURES = {
    "sft_payloads": SFT_PAYLOADS,
    "sft_records": SFT_RECORDS,
    "raw_records": RAW_RECORDS,
    "audit_raw": AUDIT_RAW,
    "audit_expected": AUDIT_EXPECTED,
    "judge_attempts": JUDGE_ATTEMPTS,
    "sft_scored": SFT_SCORED,
    "escape_texts": ESCAPE_TEXTS,
    "toml_varied": TOML_VARIED,
}
