"""SQL with the rows of each query in ``queries.py``, over the same tables, for DuckDB."""

from __future__ import annotations

from leafmill.functions.tokens import TOKEN

from .views import EQUATION_SQL, SCRIPTS, TURNS_PER_COMPLETION

# Fixed value: Python's white space, as in leafmill.functions.text.
_SPACE_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_SPACES = " || ".join(f"chr({c})" for c in _SPACE_CODES)
_TOKEN = f"'{TOKEN}'"  # a pattern that both engines read alike
_NL = "chr(10)"


def strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


DOCS = "docs AS (SELECT doc_id, CAST(doc_id AS VARCHAR) || '.txt' AS name, text, source FROM documents)"
PAGES = (
    "doc_pages AS (SELECT doc_id, CAST(ord AS BIGINT) AS page_no, line AS markdown "
    "FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, ord))"
)
PAIRS = (
    "turn_pairs AS (SELECT conv_id, turn, text AS question, nt AS answer FROM ("
    "SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr, "
    "lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM conversations) "
    "WHERE role = 'user' AND nr = 'assistant')"
)
QA = f"""{PAIRS},
numbered AS (SELECT conv_id, turn // {TURNS_PER_COMPLETION} AS part,
  CAST(row_number() OVER (PARTITION BY conv_id, turn // {TURNS_PER_COMPLETION} ORDER BY turn) AS VARCHAR) AS n, turn,
  replace(question, {_NL}, ' ') AS q, answer AS a FROM turn_pairs),
responses AS (SELECT conv_id, part,
  string_agg('Q' || n || ': ' || q || {_NL} || 'A' || n || ': ' || a, {_NL} ORDER BY turn) AS completion
  FROM numbered GROUP BY ALL),
blocks AS (SELECT conv_id, part, block, ord FROM responses,
  unnest(string_split(regexp_replace({strip('completion')}, '\\n(Q\\d?:)', chr(1) || '\\1', 'g'), chr(1)))
  WITH ORDINALITY AS u(block, ord)),
pairs AS (SELECT conv_id, part, CAST(ord - 1 AS BIGINT) AS pos,
  {strip("regexp_extract(block, 'Q\\d?:\\s*(.+)', 1)")} AS question,
  {strip("regexp_extract(block, 'A\\d?:\\s*(.+)', 1)")} AS answer FROM blocks)"""
_CPT_RESPONSE = f"'## ' || replace(text, {_NL}, {_NL} || '## ') || ' ' || chr(34) || 'end' || chr(34) || chr(92)"


def sections(key: str, table: str, completion: str) -> str:
    escaped = strip("part")
    for old, new in ((_NL, "' '"), ("chr(92)", "chr(92) || chr(92)"), ("chr(34)", "chr(92) || chr(34)")):
        escaped = f"replace({escaped}, {old}, {new})"
    return f"""sections AS (SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY ord) - 1 AS BIGINT) AS pos, text
  FROM (SELECT {key}, ord, {escaped} AS text FROM {table}, unnest(string_split({completion}, '##')) WITH ORDINALITY AS u(part, ord))
  WHERE length(text) >= 100)"""


CPT = sections("doc_id", "documents", _CPT_RESPONSE)
SYNTH = f"""synth AS (SELECT doc_id, CASE doc_id % 3
  WHEN 0 THEN 'intro' || {_NL} || '=== SYNTHETIC CONTENT 1 ===' || {_NL} || replace(text, {_NL}, {_NL} || '=== SYNTHETIC CONTENT ' || CAST(doc_id % 10 AS VARCHAR) || ' ===' || {_NL})
  WHEN 1 THEN '====synthetic content====' || replace(text, {_NL}, '====synthetic content====')
  ELSE replace(text, {_NL}, {_NL} || {_NL}) END AS completion FROM documents),
headed AS (SELECT doc_id, ord, {strip('part')} AS text FROM synth,
  unnest(string_split_regex(completion, '(?i)={{3,}}\\s*SYNTHETIC CONTENT\\s*\\d*\\s*={{3,}}')[2:]) WITH ORDINALITY AS u(part, ord)
  WHERE length({strip('part')}) > 50),
unheaded AS (SELECT doc_id, ord, {strip('part')} AS text FROM synth,
  unnest(string_split(completion, {_NL} || {_NL})) WITH ORDINALITY AS u(part, ord)
  WHERE doc_id NOT IN (SELECT doc_id FROM headed) AND length({strip('part')}) > 100),
pieces AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS BIGINT) AS pos, text
  FROM (SELECT * FROM headed UNION ALL SELECT * FROM unheaded))"""


def latex(x: str) -> str:
    return f"regexp_replace(regexp_replace({strip(x)}, '\\\\{{2,}}', chr(92) || chr(92), 'g'), '\\s+', ' ', 'g')"


def units(x: str) -> str:
    pretty = x
    for old, new in (("^{-1}", "⁻¹"), ("^{-2}", "⁻²"), ("^{2}", "²"), ("^{3}", "³")):
        pretty = f"replace({pretty}, '{old}', '{new}')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' OR lower({x}) = 'dimensionless' THEN 'dimensionless' ELSE {pretty} END"


ENTRIES = f"""responses AS ({EQUATION_SQL.replace('{part}', 'part')}),
valid AS (SELECT p_partkey, completion FROM responses WHERE json_valid(completion)),
entries AS (SELECT p_partkey, CAST(ord - 1 AS BIGINT) AS pos, j FROM valid, unnest(
  CASE WHEN json_type(completion) = 'ARRAY' THEN CAST(completion AS JSON[]) ELSE [CAST(completion AS JSON)] END)
  WITH ORDINALITY AS u(j, ord) WHERE CAST(j AS VARCHAR) <> '{{}}')"""
SYMBOLS = f"""{ENTRIES},
symbols AS (SELECT p_partkey, pos, CAST(ord - 1 AS BIGINT) AS symbol_pos, e.key AS symbol, e.value AS info
  FROM entries, unnest(map_entries(CAST(j -> 'symbols' AS MAP(VARCHAR, JSON)))) WITH ORDINALITY AS u(e, ord)),
described AS (SELECT p_partkey, pos, symbol_pos, symbol,
  coalesce(info ->> 'description', 'No description available.') AS description,
  {units("(info ->> 'unit')")} AS unit FROM symbols)"""
RENDERED = f"""{SYMBOLS},
sentences AS (SELECT p_partkey, pos, count(*) AS n,
  list('$' || symbol || '$ is the ' || lower(description) || CASE WHEN unit = 'dimensionless' THEN '' ELSE ' (in ' || unit || ')' END ORDER BY symbol_pos) AS parts,
  string_agg('• $' || symbol || '$: ' || description || CASE WHEN unit = 'dimensionless' THEN '' ELSE ' (units: ' || unit || ')' END || {_NL}, '' ORDER BY symbol_pos) AS bullets
  FROM described GROUP BY ALL),
typed AS (SELECT p_partkey, pos, {latex("(j ->> 'equation')")} AS equation, coalesce(j ->> 'description', 'No description available.') AS description,
  j ->> 'description' AS given, CAST(j -> 'conditions' AS VARCHAR[]) AS conditions, j ->> 'source' AS source, n, parts, bullets
  FROM entries LEFT JOIN sentences USING (p_partkey, pos)),
rendered AS (SELECT p_partkey, pos,
  'The equation $' || equation || '$ represents ' || lower(description) || ' '
  || CASE WHEN n IS NULL THEN '' WHEN n = 1 THEN 'In this equation, ' || parts[1] || '. '
     ELSE 'In this equation, ' || array_to_string(parts[:n - 1], ',' || {_NL} || ' ') || ',' || {_NL} || ' and ' || parts[n] || '. ' END
  || CASE WHEN conditions IS NULL THEN '' ELSE 'This equation is applicable under the following conditions: '
     || lower(array_to_string(conditions, ',' || {_NL} || ' ')) || '. ' END
  || CASE WHEN source IS NULL OR source = 'Unknown Source' THEN '' ELSE 'This relationship is documented in ' || source || '.' END AS text,
  'What does the equation $' || equation || '$ represent?' AS question,
  description || ' ' || CASE WHEN n IS NULL THEN '' ELSE 'The symbols in this equation represent:' || {_NL} || bullets END
  || CASE WHEN conditions IS NULL THEN '' ELSE {_NL} || 'This equation is typically used under these conditions: '
     || lower(array_to_string(conditions, ', ')) || '.' END AS answer,
  'What does the following equation represent?' || {_NL} || {_NL} || equation AS input,
  coalesce(given, 'No explanation provided.') AS response
  FROM typed)"""


def chunks(size: int, source: str = "docs") -> str:
    return f"""toks AS (SELECT *, regexp_extract_all(text, {_TOKEN}) AS t FROM {source}),
cut AS (SELECT * EXCLUDE (text, t), CAST(ceil(len(t) / {size}) AS BIGINT) AS n_chunks, CAST(k + 1 AS BIGINT) AS chunk_no,
  array_to_string(t[k * {size} + 1:(k + 1) * {size}], '') AS text
  FROM (SELECT *, unnest(range(0, CAST(ceil(len(t) / {size}) AS BIGINT))) AS k FROM toks)),
chunks AS (SELECT * EXCLUDE (name), CASE WHEN n_chunks > 1 THEN name || ' (chunk ' || CAST(chunk_no AS VARCHAR) || ')' ELSE name END AS name,
  name AS doc FROM cut)"""


def prompts(size: int, batch: int, template: str, order: str, docs: str = DOCS) -> str:
    return f"""{docs}, {chunks(size)},
placed AS (SELECT *, row_number() OVER (ORDER BY {order}, chunk_no) - 1 AS idx FROM chunks),
prompts AS (SELECT CAST(idx // {batch} AS BIGINT) AS batch_idx, {template}
  || string_agg('Source Document ' || CAST(idx + 1 AS VARCHAR) || ' (' || name || '):' || {_NL} || {strip('text')} || {_NL} || {_NL}, '' ORDER BY idx)
  || 'Now generate synthetic training content by rephrasing and restructuring the information from these sources:' || {_NL} AS prompt
  FROM placed GROUP BY ALL)"""


PROMPTS = prompts(400, 3, f"'Rewrite these sources.' || {_NL}", "doc_id")


def combined(order: str) -> str:
    return f"""WITH {DOCS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {order}) - 1 AS r FROM docs)
SELECT source, CAST(r // 25 AS BIGINT) AS part_no, count(*) AS n_docs,
  string_agg('# ' || name || {_NL} || text, {_NL} || {_NL} ORDER BY r) AS text FROM ranked GROUP BY source, r // 25"""


def manifest(where: str = "") -> str:
    return f"""WITH listing AS (SELECT source AS category, CAST(doc_id AS VARCHAR) || CASE doc_id % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.JSON' WHEN 2 THEN '.jsonl' WHEN 3 THEN '.pdf' ELSE '.zip' END AS name,
  CASE WHEN doc_id % 4 = 0 THEN n_chars % 1024 ELSE n_chars * 2048 + 1 END AS length FROM documents)
SELECT category, name, CAST(length AS BIGINT) AS size_bytes,
  CASE WHEN length < 1024 THEN CAST(length AS VARCHAR) || ' B' WHEN length < 1048576 THEN printf('%.0f KB', length / 1024.0)
    ELSE printf('%.1f MB', length / 1048576.0) END AS size, string_split(name, '.')[2] AS ext FROM listing {where} ORDER BY category, name"""


_COMPLETE = "SELECT doc_id, 'rag' AS task, CASE WHEN doc_id % 7 = 0 THEN 'error' WHEN doc_id % 9 = 0 THEN 'empty' ELSE 'ok' END AS status, text FROM documents"
_DOWN = "RuntimeError: service unavailable"
PAIR_JSON = "SELECT conv_id, turn, CAST({} AS VARCHAR) AS json FROM turn_pairs"
_FT_JSON = "json_object('messages', json_array(json_object('role', 'user', 'content', question), json_object('role', 'assistant', 'content', answer)))"
EQUATIONS_OF_DOCS = f"""lengths AS (SELECT name, 'E_{{' || CAST(length(text) AS VARCHAR) || '}}' AS equation, text AS description FROM docs),
equation_records AS (SELECT name, 0::BIGINT AS pos, dataset, CAST(json AS VARCHAR) AS json FROM (
  SELECT name, 'pretraining' AS dataset, json_object('text', 'The equation $' || equation || '$ represents ' || lower(description) || ' In this equation, $n$ is the length. ') AS json FROM lengths
  UNION ALL SELECT name, 'finetuning', {_FT_JSON.replace('question', "'What does the equation $' || equation || '$ represent?'").replace('answer', f"description || ' The symbols in this equation represent:' || {_NL} || '• $n$: Length' || {_NL}")} FROM lengths
  UNION ALL SELECT name, 'conversation', json_object('input', 'What does the following equation represent?' || {_NL} || {_NL} || equation, 'response', description) FROM lengths))"""
_LINES = "unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, ord)"



def existing_lines(shape: str) -> str:
    json = "json_object('text', text)" if shape == "pretraining" else _FT_JSON.replace("question", "text").replace("answer", "'yes'")
    return f"""shaped AS (SELECT doc_id, CAST({json} AS VARCHAR) AS json FROM documents),
existing AS (SELECT CASE WHEN doc_id % 13 = 5 THEN json[:9] WHEN doc_id % 11 = 5 THEN '{{"note":' || CAST(doc_id AS VARCHAR) || '}}'
  WHEN doc_id % 17 = 5 THEN '[' || json || ']' WHEN doc_id % 3 = 0 THEN json[:-2] || ', "id" : ' || CAST(doc_id AS VARCHAR) || ' }}' ELSE json END AS line,
  CASE WHEN doc_id % 13 = 5 THEN 'invalid_json' WHEN doc_id % 11 = 5 THEN NULL WHEN doc_id % 17 = 5 THEN 'not_an_object' END AS reason FROM shaped)"""


def corpus_files(shape: str, new: dict[str, str]) -> str:
    lines = " UNION ALL ".join(f"SELECT line FROM {name}" for name in new)
    tables = ", ".join(f"{name} AS ({sql})" for name, sql in new.items())
    return f"""WITH {existing_lines(shape)}, {tables}, fresh AS ({lines})
SELECT 'new' AS corpus, CAST(NULL AS VARCHAR) AS reason, line FROM fresh UNION ALL SELECT 'merged', NULL, line FROM fresh
UNION ALL SELECT 'merged', reason, line FROM existing"""


def digest(output: str, table: str, *columns: str) -> str:
    parts = ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"""SELECT 'output' AS kind, '{output}' AS name, count(*) AS n, CAST(sum(CAST('0x' || md5(concat_ws(chr(31), {parts}))[:15] AS BIGINT)) % {1 << 60} AS BIGINT) AS digest,
  CAST(NULL AS VARCHAR) AS state FROM {table}"""


def job_all() -> str:
    """All outputs of the job, made from the pages; then their lines and digests, and the states of the steps."""
    docs = f"""{PAGES}, docs AS (SELECT CAST(doc_id AS VARCHAR) || '_part_' || CAST((page_no - 1) // 10 + 1 AS VARCHAR) AS name,
  string_agg({_NL} || {_NL} || '# Page ' || CAST((page_no - 1) % 10 + 1 AS VARCHAR) || {_NL} || markdown, '' ORDER BY page_no) AS text
  FROM doc_pages GROUP BY doc_id, (page_no - 1) // 10)"""
    pieces = f"""pieces AS (SELECT batch_idx, 0::BIGINT AS pos, {strip('prompt')} AS text FROM prompts WHERE len(regexp_extract_all(prompt, {_TOKEN})) <= 5000),
qa AS (SELECT name, CAST(ord - 1 AS BIGINT) AS pos, CAST({_FT_JSON.replace('question', strip("'line ' || line")).replace('answer', "'see above'")} AS VARCHAR) AS json FROM docs, {_LINES})"""
    lines = """new_pretraining AS (SELECT json AS line FROM equation_records WHERE dataset = 'pretraining'
  UNION ALL SELECT CAST(json_object('text', text) AS VARCHAR) FROM pieces UNION ALL SELECT CAST(json_object('text', text) AS VARCHAR) FROM sections),
new_finetuning AS (SELECT json AS line FROM equation_records WHERE dataset = 'finetuning' UNION ALL SELECT json FROM qa)"""
    counts = " UNION ALL ".join(
        f"SELECT 'lines' AS kind, '{name}' AS name, count(*) AS n, CAST(NULL AS BIGINT) AS digest, CAST(NULL AS VARCHAR) AS state FROM {table}"
        for name, table in {
            "equations_ft": "equation_records WHERE dataset = 'finetuning'", "equations_cpt": "equation_records WHERE dataset = 'pretraining'",
            "qa_pairs": "qa", "synthetic": "pieces",
        }.items())
    steps = ", ".join(f"('{step}')" for step in ("assemble", "rag", "equations", "synth", "qa", "gen_cpt", "gen_ft"))
    digests = " UNION ALL ".join([
        digest("page_texts", "docs", "name", "text"), digest("cpt_sections", "sections", "name", "pos", "text"),
        digest("equation_records", "equation_records", "name", "pos", "dataset", "json"), digest("synthetic_pieces", "pieces", "batch_idx", "pos", "text"),
        digest("qa_records", "qa", "name", "pos", "json"), digest("new_pretraining", "new_pretraining", "line"), digest("new_finetuning", "new_finetuning", "line"),
    ])
    return f"""WITH {prompts(1500, 1, "'Prompt for synthetic.'", "doc", docs)}, {sections('name', 'docs', _CPT_RESPONSE)}, {EQUATIONS_OF_DOCS}, {pieces}, {lines}
{counts} UNION ALL SELECT 'step', step, NULL, NULL, 'done' FROM (VALUES {steps}) AS t(step) UNION ALL {digests}"""


ORACLES: dict[str, str] = {
    "read_text_docs": f"""SELECT 'folder=' || CAST(doc_id % 16 AS VARCHAR) AS key_folder, true AS key_ends_in_name, doc_id % 16 AS folder,
  string_agg(text || {_NL}, '' ORDER BY doc_id) AS text FROM documents GROUP BY doc_id % 16, doc_id // 1600""",
    "text_rejects": """SELECT 'folder=' || CAST(doc_id % 16 AS VARCHAR) AS key_folder, true AS key_ends_in_name, 'not_utf8' AS reason
  FROM documents WHERE doc_id % 16 % 5 = 2 GROUP BY doc_id % 16, doc_id // 1600""",
    "jsonl_rejects": f"WITH {existing_lines('pretraining')} SELECT reason, line FROM existing WHERE reason IS NOT NULL",
    "read_equation_json": f"""WITH {ENTRIES} SELECT bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY p_partkey, pos) - 1 AS BIGINT) AS pos, equation, description
FROM (SELECT p_partkey // 50 AS bucket, p_partkey, pos, j ->> 'equation' AS equation, j ->> 'description' AS description FROM entries) WHERE bucket % 5 <> 4""",
    "read_jsonl": "SELECT text FROM documents",
    "page_chunks": f"""WITH {PAGES} SELECT doc_id, (page_no - 1) // 10 + 1 AS chunk_no,
  CAST(doc_id AS VARCHAR) || '_part_' || CAST((page_no - 1) // 10 + 1 AS VARCHAR) AS chunk_name, count(*) AS n_pages,
  min(page_no) AS first_page, max(page_no) AS last_page FROM doc_pages GROUP BY ALL""",
    "page_counts": f"WITH {PAGES} SELECT doc_id, count(*) AS total_pages FROM doc_pages GROUP BY doc_id",
    "page_positions": f"""WITH {PAGES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_no * 7 - page_no % 3) AS page_no, markdown FROM doc_pages""",
    "assemble_pages": f"""WITH {PAGES} SELECT doc_id, (page_no - 1) // 10 + 1 AS chunk_no,
  string_agg({_NL} || {_NL} || '# Page ' || CAST((page_no - 1) % 10 + 1 AS VARCHAR) || {_NL} || markdown, '' ORDER BY page_no) AS text FROM doc_pages GROUP BY 1, 2""",
    "combine_documents": combined("doc_id"),
    "combine_documents_by_name": combined("name"),
    "combine_documents_by_bytes": f"""WITH {DOCS}, sized AS (SELECT *, strlen('# ' || name || {_NL} || text) + 2 AS b FROM docs),
placed AS (SELECT *, CAST(b > 3000 AS BIGINT) AS large, row_number() OVER w - 1 AS r, coalesce(sum(b) OVER p, 0) AS before,
  coalesce(sum(CAST(b > 3000 AS BIGINT)) OVER p, 0) AS larges FROM sized
  WINDOW w AS (PARTITION BY source ORDER BY doc_id), p AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
parts AS (SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY r // 25, before // 3000, 2 * larges + large) - 1 AS part_no FROM placed)
SELECT source, part_no, count(*) AS n_docs, string_agg('# ' || name || {_NL} || text, {_NL} || {_NL} ORDER BY r) AS text FROM parts GROUP BY source, part_no""",
    "token_units": f"""WITH texts AS ({" UNION ALL ".join(f"SELECT doc_id, '{n}' AS name, translate(text, '{a}', '{b}') AS text FROM documents" for n, a, b in SCRIPTS)}
UNION ALL SELECT doc_id, 'run', left(repeat(replace(replace(text[:200], ' ', '_'), {_NL}, '_') || '-', CAST(100000 // (length(text[:200]) + 1) + 1 AS BIGINT)), 100000)
  FROM documents WHERE doc_id % 50 = 0), {chunks(50, 'texts')}
SELECT doc_id, name, chunk_no, n_chunks, length(text) AS n_chars, md5(text) AS md5 FROM chunks""",
    "over_budget_rejects": f"""WITH {prompts(400, 1, "'Prompt for synthetic.'", "doc")}, counted AS (SELECT batch_idx, CAST(len(regexp_extract_all(prompt, {_TOKEN})) AS BIGINT) AS n_tokens FROM prompts)
SELECT batch_idx, n_tokens, 'over_budget' AS reason FROM counted WHERE n_tokens > 300""",
    "render_rejects": """SELECT doc_id, 0::BIGINT AS pos, CASE WHEN doc_id % 5 > 1 THEN 'x' END AS equation,
  CASE doc_id % 5 WHEN 1 THEN 'missing_equation' WHEN 2 THEN 'null_description' END AS pretraining_reason,
  CASE doc_id % 5 WHEN 1 THEN 'missing_equation' WHEN 2 THEN 'null_description' ELSE 'symbol_not_object' END AS finetuning_reason
FROM documents WHERE doc_id % 5 IN (1, 2, 3)""",
    "token_count": f"SELECT doc_id, CAST(len(regexp_extract_all(text, {_TOKEN})) AS BIGINT) AS n_tokens FROM documents",
    "token_chunks": f"WITH {DOCS}, {chunks(50)} SELECT doc_id, name, chunk_no, n_chunks, text FROM chunks",
    "fixed_batches": f"""WITH {DOCS}, placed AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM docs)
SELECT idx // 3 AS batch_idx, count(*) OVER (PARTITION BY idx // 3) AS n_items, idx, doc_id, name, length(text) AS n FROM placed""",
    "token_budget": f"""WITH {PROMPTS} SELECT batch_idx, n_tokens, n_tokens > 1000 AS over_budget
FROM (SELECT batch_idx, CAST(len(regexp_extract_all(prompt, {_TOKEN})) AS BIGINT) AS n_tokens FROM prompts)""",
    "synth_prompts": f"WITH {PROMPTS} SELECT batch_idx, prompt FROM prompts",
    "chat_requests": """SELECT doc_id, task, 'default' AS model, temperature, 'system' AS role_0, 'Prompt for ' || task || '.' AS content_0, 'user' AS role_1, text AS content_1
FROM documents, (VALUES ('rag', 0.5::DOUBLE), ('cpt', 0.5::DOUBLE), ('qa', 0.7::DOUBLE), ('equations', 0.3::DOUBLE)) AS t(task, temperature)""",
    "complete": f"""SELECT doc_id, task, status, CASE WHEN status = 'ok' THEN text END AS completion, CASE WHEN status = 'error' THEN '{_DOWN}' END AS error FROM ({_COMPLETE})""",
    "complete_validated": f"""SELECT doc_id, status, CAST(CASE WHEN status = 'ok' AND doc_id % 5 <> 0 THEN 1 ELSE 2 END AS BIGINT) AS attempts,
  CASE WHEN status = 'ok' THEN 'good ' || text END AS completion, CASE WHEN status = 'error' THEN '{_DOWN}' END AS error
FROM (SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN 'error' WHEN doc_id % 11 = 0 THEN 'invalid' ELSE 'ok' END AS status FROM documents)""",
    "retry_failed": """SELECT doc_id, CASE WHEN doc_id % 21 = 0 THEN 'error' ELSE 'ok' END AS status,
  CAST(CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts, CASE WHEN doc_id % 21 <> 0 THEN text END AS completion FROM documents""",
    "pending_only": """SELECT doc_id, n_chars, task FROM documents, (VALUES ('rag'), ('cpt')) AS t(task)
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND task = CASE WHEN l.quality = 1 THEN 'rag' ELSE 'cpt' END)""",
    "ingest_new": f"""SELECT 'drop=' || CAST(doc_id % 16 % 2 AS VARCHAR) || '/folder=' || CAST(doc_id % 16 AS VARCHAR) AS folder, line
  FROM documents, {_LINES} WHERE line <> ''""",
    "validate_records": f"""WITH {QA} SELECT batch, CAST(coalesce(n, 0) AS BIGINT) AS n_rows, coalesce(ok, false) AS valid
FROM (SELECT DISTINCT conv_id // 2 AS batch FROM conversations)
LEFT JOIN (SELECT conv_id // 2 AS batch, count(*) AS n, bool_and(length(answer) >= 40) AS ok FROM pairs GROUP BY 1) USING (batch)""",
    "validate_equations": f"""WITH {ENTRIES} SELECT p_partkey // 3 AS batch, count(v.completion) AS n_rows, count(v.completion) > 0 AS valid
FROM part LEFT JOIN (SELECT * FROM valid WHERE completion <> '[]') v USING (p_partkey) GROUP BY 1""",
    "cpt_sections": f"WITH {CPT} SELECT * FROM sections",
    "qa_pairs": f"WITH {QA} SELECT * FROM pairs",
    "synth_pieces": f"WITH {SYNTH} SELECT * FROM pieces",
    "equation_entries": f"""WITH {ENTRIES} SELECT p_partkey, pos, CAST(len(json_keys(j)) AS BIGINT) AS n_fields, j ->> 'equation' AS equation,
  j ->> 'description' AS description, j ->> 'source' AS source FROM entries""",
    "equation_rejects": f"WITH {ENTRIES} SELECT p_partkey, 'invalid_json' AS reason FROM responses WHERE NOT json_valid(completion)",
    "latex_normalize": f"""WITH {ENTRIES} SELECT p_partkey, pos, {latex("(j ->> 'equation')")} AS latex FROM entries""",
    "format_units": f"WITH {SYMBOLS} SELECT p_partkey, pos, symbol, unit FROM described",
    "symbol_info": f"WITH {SYMBOLS} SELECT p_partkey, pos, symbol_pos, symbol, description, unit FROM described",
    "equation_pretraining": f"WITH {RENDERED} SELECT p_partkey, pos, text FROM rendered",
    "equation_finetuning": f"WITH {RENDERED} SELECT p_partkey, pos, question, answer FROM rendered",
    "equation_instruction": f"WITH {RENDERED} SELECT p_partkey, pos, input, response FROM rendered",
    "equation_datasets": f"""WITH {RENDERED}, made AS (SELECT 'pretraining' AS dataset, json_object('text', text) AS json FROM rendered
  UNION ALL SELECT 'finetuning', {_FT_JSON} FROM rendered UNION ALL SELECT 'conversation', json_object('input', input, 'response', response) FROM rendered)
SELECT dataset, count(*) AS n_records, CAST(sum(length(CAST(json AS VARCHAR))) AS BIGINT) AS n_chars FROM made GROUP BY dataset""",
    "to_pretraining": "SELECT doc_id, CAST(json_object('text', text) AS VARCHAR) AS json FROM documents",
    "to_finetuning": f"WITH {PAIRS} {PAIR_JSON.format(_FT_JSON)}",
    "to_instruction": f"""WITH {PAIRS} {PAIR_JSON.format("json_object('input', question, 'response', answer)")}""",
    "merge_records": """SELECT 0::BIGINT AS source_ord, text FROM documents UNION ALL SELECT 1, text FROM conversations UNION ALL SELECT 2, text FROM documents""",
    "cpt_corpus": f"""SELECT 0::BIGINT AS source_ord, text FROM documents UNION ALL SELECT 1, text FROM (WITH {RENDERED} SELECT text FROM rendered)
UNION ALL SELECT 2, text FROM (WITH {SYNTH} SELECT text FROM pieces) UNION ALL SELECT 3, text FROM (WITH {CPT} SELECT text FROM sections)""",
    "ft_corpus": f"""SELECT 0::BIGINT AS source_ord, question, answer FROM (WITH {PAIRS} SELECT question, answer FROM turn_pairs)
UNION ALL SELECT 1, question, answer FROM (WITH {RENDERED} SELECT question, answer FROM rendered)
UNION ALL SELECT 2, question, answer FROM (WITH {QA} SELECT question, answer FROM pairs)""",
    "cpt_corpus_files": corpus_files("pretraining", {
        "equations": f"SELECT CAST(json_object('text', text) AS VARCHAR) AS line FROM (WITH {RENDERED} SELECT text FROM rendered)",
        "synthetic": f"SELECT CAST(json_object('text', text) AS VARCHAR) AS line FROM (WITH {SYNTH} SELECT text FROM pieces)",
        "sections": f"SELECT CAST(json_object('text', text) AS VARCHAR) AS line FROM (WITH {CPT} SELECT text FROM sections)",
    }),
    "ft_corpus_files": corpus_files("finetuning", {
        "equations": f"SELECT CAST({_FT_JSON} AS VARCHAR) AS line FROM (WITH {RENDERED} SELECT question, answer FROM rendered)",
        "qa": f"SELECT CAST({_FT_JSON} AS VARCHAR) AS line FROM (WITH {QA} SELECT question, answer FROM pairs)",
    }),
    "write_jsonl": f"WITH {PAIRS} SELECT question, answer FROM turn_pairs",
    "equation_json_docs": f"WITH {ENTRIES} SELECT p_partkey, completion AS json FROM valid WHERE completion <> '[]'",
    "write_text_docs": f"""WITH {DOCS} SELECT name, task || ':1:' || text AS text, task FROM docs, (VALUES ('rag'), ('cpt')) AS t(task)""",
    "dataset_stats": f"""SELECT dataset, n_lines FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('absent')) AS t(dataset)
LEFT JOIN (SELECT lang AS dataset, count(*) FILTER (length({strip('line')}) > 0) AS n_lines FROM documents, {_LINES} GROUP BY lang) USING (dataset)""",
    "output_manifest": manifest(),
    "backup_manifest": manifest("WHERE lower(string_split(name, '.')[2]) IN ('pdf', 'txt', 'json', 'jsonl')"),
    "job_rag_cpt": f"WITH {DOCS}, {sections('name', 'docs', _CPT_RESPONSE)} SELECT * FROM sections",
    "job_equations": f"WITH {DOCS}, {EQUATIONS_OF_DOCS} SELECT name, pos, dataset, json FROM equation_records",
    "job_qa": f"""WITH {DOCS} SELECT name, CAST(ord - 1 AS BIGINT) AS pos, {strip("'line ' || line")} AS question, 'see above' AS answer FROM docs, {_LINES}""",
    "job_synthetic": f"""WITH {prompts(400, 1, "'Prompt for synthetic.'", "doc")} SELECT batch_idx, 0::BIGINT AS pos, {strip('prompt')} AS text FROM prompts
WHERE len(regexp_extract_all(prompt, {_TOKEN})) <= 5000""",
    "job_all": job_all(),
}
