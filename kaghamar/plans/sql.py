"""DuckDB SQL of the registered queries, with the same column names; those that SQL can't say have none."""

from __future__ import annotations

from kaghamar.functions import text as X

#: The same white space and kept characters in the notation of RE2.
WS_RE2 = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
KEEP_RE2 = r"\x{0530}-\x{058F}\x{FB13}-\x{FB17} \n\t.,;:!?\-()\"''0-9"
LETTERS_RE2 = r"\x{0531}-\x{0556}\x{0559}\x{0560}-\x{0588}\x{FB13}-\x{FB17}"


def lit(s: str) -> str:
    """A SQL string, by way of chr() for line breaks."""
    parts = [f"'{p}'" for p in s.replace("'", "''").split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS_RE2}+|{WS_RE2}+\\z', '', 'g')"


def ws_clean(e: str) -> str:
    return strip(f"regexp_replace(coalesce({e}, ''), '{WS_RE2}+', ' ', 'g')")


def norm_key(e: str) -> str:
    return f"lower({ws_clean(e)})"


def clean(e: str, keep: str = KEEP_RE2) -> str:
    kept = f"regexp_replace(nfc_normalize({e}), '[^{keep}]', '', 'g')"
    return strip(f"regexp_replace(regexp_replace({kept}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


#: The markup rules in the notation of RE2, written out by themselves; a replacement is a SQL expression.
WIKI_RE2 = (
    ("<[^>]+>", "''"),
    (r"\{\{[^}]*\}\}", "''"),
    (r"\[\[([^|\]]*\|)?([^\]]*)\]\]", r"'\2'"),
    (r"\[https?://[^" + WS_RE2[1:] + "+" + WS_RE2 + r"*([^\]]*)\]", r"'\1'"),
    (r"\[\[(Категория|Category|Պատկdelays|File|Файл|Image):[^\]]*\]\]", "''"),
    (r"\x27\x27+", "''"),
    (r"==+([^\n]+?)==+", r"'\1'"),
    (r"(?s)<ref[^>]*>.*?</ref>", "''"),
    (r"<ref[^/]*/?>", "''"),
    (r"&[A-Za-z]+;", "' '"),
    (r"&#\d+;", "' '"),
    (r"(?s)\{\|.*?\|\}", "''"),
    (r"(?m)^" + WS_RE2 + r"*[!|][^\n]*$", "''"),
    (r"\n\n\n+", "chr(10) || chr(10)"),
    (r"(?m)^" + WS_RE2 + "*[#*:;]+" + WS_RE2 + "*$", "''"),
)


def wiki(e: str) -> str:
    for pattern, into in WIKI_RE2:
        e = f"regexp_replace({e}, '{pattern}', {into}, 'g')"
    return strip(e)


def any_of(e: str, substrings: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({e}, {lit(s)})" for s in substrings) + ")"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round({part} / {whole} * 100, 1) ELSE 0.0 END"


#: The entities that the fixture holds, and the usual ones.
_ENTITIES = {"&nbsp;?": "chr(160)", "&#171;?": "'«'", "&#187;?": "'»'", "&quot;": "chr(34)", "&lt;": "'<'", "&gt;": "'>'", "&amp;": "'&'"}
_CHUNK = "chunk"
for _name, _char in _ENTITIES.items():
    _CHUNK = f"regexp_replace({_CHUNK}, '{_name}', {_char}, 'g')"
HTML = f"regexp_replace(regexp_replace({_CHUNK}, '(?i)<br[ \\t\\n\\x0b\\f\\r]*/?>', chr(10), 'g'), '(?i)</p>', chr(10) || chr(10), 'g')"
HTML = strip(f"regexp_replace(regexp_replace(regexp_replace({HTML}, '<[^>]+>', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")
PAIRS = """pairs AS (
  SELECT pair_id, instruction, input, output, source, 0 AS rank FROM armenian_qa_qwen
  UNION ALL SELECT pair_id, instruction, input, output, source, 1 FROM qa_merged
  UNION ALL SELECT pair_id, instruction, input, output, source, 2 FROM aya_armenian)"""
FLAGGED = f"""raw AS (
  SELECT c.source, o.priority, c.pos, c.para_id, length(c.text) AS chars_in, {clean('c.text')} AS clean
  FROM corpus_raw c JOIN source_order o USING (source) WHERE c.text IS NOT NULL),
flagged AS (
  SELECT *, length(clean) AS chars_out, CASE WHEN length(clean) < 50 THEN 'short'
    WHEN row_number() OVER (PARTITION BY clean, length(clean) < 50 ORDER BY priority, pos, para_id) = 1 THEN 'kept' ELSE 'duplicate' END AS fate FROM raw)"""
STATS = f"""{FLAGGED}, agg AS (
  SELECT source, CAST(sum(chars_in) AS BIGINT) AS chars_in, CAST(sum(CASE WHEN fate = 'kept' THEN chars_out + 2 ELSE 0 END) AS BIGINT) AS chars_out,
    count(*) FILTER (fate = 'kept') AS kept, count(*) FILTER (fate = 'short') AS dropped_short, count(*) FILTER (fate = 'duplicate') AS dropped_duplicates
  FROM flagged GROUP BY source),
stats AS (
  SELECT o.source, o.priority, CASE WHEN kept IS NULL THEN 'missing' ELSE 'ok' END AS status, coalesce(chars_in, 0) AS chars_in, coalesce(chars_out, 0) AS chars_out,
    coalesce(kept, 0) AS kept, coalesce(dropped_short, 0) AS dropped_short, coalesce(dropped_duplicates, 0) AS dropped_duplicates
  FROM source_order o LEFT JOIN agg USING (source))"""
REASONS = f"""CASE WHEN q = '' OR a = '' THEN 'empty' WHEN NOT length(q) BETWEEN 10 AND 2000 THEN 'question_length' WHEN NOT length(a) BETWEEN 20 AND 2000 THEN 'answer_length'
  WHEN {any_of('q', X.ARTIFACTS)} OR {any_of('a', X.ARTIFACTS)} THEN 'artifact'
  WHEN ra < 0.75 OR rq < 0.55 THEN 'script' WHEN lower(q) = lower(a) THEN 'same' WHEN length(q) > 300 AND length(a) < 15 THEN 'stub' ELSE 'kept' END"""


def ratio(e: str, letters: str = LETTERS_RE2) -> str:
    total = f"len(regexp_extract_all({e}, '\\p{{L}}'))"
    return f"CASE WHEN {total} > 0 THEN len(regexp_extract_all({e}, '[{letters}]')) / {total} ELSE 0.0 END"


def aya(source: str) -> str:
    return f"""cleaned AS (SELECT pair_id, source, {ws_clean('instruction')} AS q, {ws_clean('output')} AS a FROM {source}),
rated AS (SELECT *, {ratio('a')} AS ra, {ratio('q')} AS rq FROM cleaned), judged AS (SELECT *, {REASONS} AS reason FROM rated)"""


SAMPLE = "(SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || pair_id)) AS r FROM aya_armenian)"
NATIONS = """names AS (SELECT list(r_name ORDER BY r_regionkey) AS choices FROM region),
nations AS (
  SELECT n_nationkey, n_regionkey, r_name, choices, ' Where is ' || n_name || '? ' AS question,
    CASE WHEN n_nationkey % 3 = 0 THEN 'int' ELSE 'str' END AS label_kind,
    CASE n_nationkey % 3 WHEN 1 THEN CAST(n_regionkey + 1 AS VARCHAR) WHEN 2 THEN chr(CAST(n_regionkey + 65 AS INTEGER)) END AS label_str,
    CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey END AS label_int
  FROM nation JOIN region ON n_regionkey = r_regionkey, names)"""
_L = "['Ա','Բ','Գ','Դ','Ե','Զ','Է','Ը','Թ','Ժ']"


def mcq(question: str, choices: str, place: str, context: str | None) -> tuple[str, str]:
    lines = f"array_to_string(list_transform(range(1, len({choices}) + 1), lambda i: {_L}[i] || ') ' || trim({choices}[i])), chr(10))"
    body = f"CASE WHEN coalesce({context}, '') <> '' THEN 'Տեքստ:' || chr(10) || trim({context}) || chr(10) || chr(10) || 'Հարց: ' || trim({question}) ELSE trim({question}) END" if context else f"trim({question})"
    return f"({body}) || chr(10) || chr(10) || {lines}", f"{_L}[{place} + 1] || ') ' || trim({choices}[{place} + 1])"


_MCQ = mcq("question", "choices", "n_regionkey", "CASE WHEN n_nationkey % 2 = 0 THEN r_name END")
_FULL = "trim(CASE WHEN n_nationkey % 5 = 0 THEN 'Task ' ELSE '' END || trim(question))"
_EXAM = mcq(_FULL, "choices", "n_regionkey", "CASE WHEN n_nationkey % 2 = 0 THEN r_name END")
_FOUR = mcq("question", "choices[1:4]", "place", "r_name")
_CHARS = """chars AS (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM corpus_raw), vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY encode(token)) - 1 AS INTEGER) AS id FROM chars WHERE token <> '')"""
_STREAM = f"""{_CHARS}, pieces AS (SELECT pair_id, unnest(string_split(output, '')) AS token, generate_subscripts(string_split(output, ''), 1) AS i FROM qa_merged WHERE output <> ''),
stream AS (SELECT pair_id, i, id, token, row_number() OVER (ORDER BY pair_id, i) - 1 AS place FROM pieces JOIN vocab USING (token))"""
_CHAT = f"""chats AS (SELECT pair_id, '{X.USER}' || CASE WHEN {strip("coalesce(input, '')")} <> '' THEN {strip('instruction')} || chr(10) || {strip("coalesce(input, '')")} ELSE {strip('instruction')} END
  || '{X.END}{X.ASSISTANT}' || {strip('output')} || '{X.END}' AS chat FROM qa_merged WHERE instruction IS NOT NULL AND output IS NOT NULL)"""
_FENCED = "fenced AS (SELECT pair_id, CASE WHEN pair_id % 2 = 0 THEN '```json' || chr(10) || output || chr(10) || '```' ELSE output END AS t FROM qa_merged WHERE output IS NOT NULL)"
_MARKED = f"""{lit("== Վերնագիր ==" + chr(10) + "'''")} || output || {lit("'''<ref name=" + chr(34) + "a" + chr(34) + ">b</ref> [[Category:X]] [[a|b|c]] [[plain]] [https://x.example/y label] {{t|u}} &nbsp; &#160;" + chr(10) + "{| t" + chr(10) + "| c" + chr(10) + "|}" + chr(10) + "| row" + chr(10) + " * " + chr(10) + "#:;" + chr(10) * 4 + "end <br/>")}"""
_LINES = "regexp_replace(text, '\\r\\n|\\r', chr(10), 'g')"


def split(separator: str, least: int) -> str:
    return f"""WITH p AS (SELECT doc_id, string_split_regex({_LINES}, '{separator}') AS p FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, len(p) AS n, unnest(p) AS paragraph, generate_subscripts(p, 1) - 1 AS pos FROM p)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, paragraph FROM u WHERE length(paragraph) >= {least} OR (pos = n - 1 AND length(regexp_replace(paragraph, '{WS_RE2}', '', 'g')) > 0)"""


def reason(raw: str, clean_text: str) -> str:
    return f"CASE WHEN doc_id % 4 <> 0 THEN 'ns' WHEN coalesce({raw}, '') = '' THEN 'empty' WHEN starts_with({raw}, '{X.REDIRECTS[0]}') OR starts_with({raw}, '{X.REDIRECTS[1]}') THEN 'redirect' WHEN length({raw}) < 200 OR length({clean_text}) <= 100 THEN 'short' ELSE 'kept' END"


def tidy(e: str) -> str:
    return strip(f"regexp_replace({strip(e)}, '^\"+|\"+$', '', 'g')")


_BODY = HTML.replace("chunk", "coalesce(json_extract_string(chunk, '$.body'), '')")
_ESCAPED = "substr(CAST(to_json({0}) AS VARCHAR), 2, length(CAST(to_json({0}) AS VARCHAR)) - 2)"
#: What the sweep over broken JSON sees: escapes stay, and an answer ends where a quote is followed by the end of a value.
_RESPONSES = f"""raw AS (SELECT pair_id, CASE WHEN pair_id % 4 = 2 THEN {_ESCAPED.format("instruction")} ELSE instruction END AS q,
    CASE pair_id % 4 WHEN 2 THEN regexp_extract({_ESCAPED.format("output")} || '"}}', '(?s)^(.+?)"{WS_RE2}*[}},\n]', 1) WHEN 3 THEN regexp_extract(output || '"}}', '(?s)^(.+?)"{WS_RE2}*[}},\n]', 1) ELSE output END AS a
  FROM armenian_qa_qwen WHERE instruction IS NOT NULL AND output IS NOT NULL), r AS (SELECT pair_id, {tidy('q')} AS q, {tidy('a')} AS a FROM raw)"""


ORACLE: dict[str, str] = {
    "corpus_paragraph_split": split(f"\\n{WS_RE2}*\\n+", 50),
    "corpus_line_split": split("\\n", 80),
    "corpus_clean_text": f"SELECT para_id, {clean('text')} AS clean FROM corpus_raw",
    "corpus_clean_latin": f"SELECT para_id, {clean('text', KEEP_RE2 + 'A-Za-z')} AS clean FROM corpus_raw",
    "corpus_priority_dedup": f"WITH {FLAGGED} SELECT para_id, source, pos, CAST(chars_out AS INTEGER) AS n_chars FROM flagged WHERE fate = 'kept'",
    "corpus_no_dedup": f"WITH {FLAGGED} SELECT para_id, source, pos, CAST(chars_out AS INTEGER) AS n_chars FROM flagged WHERE fate <> 'short'",
    "corpus_source_stats": f"WITH {STATS} SELECT *, {pct('(chars_in - chars_out)', 'chars_in')} AS compression_pct, {pct('dropped_duplicates', '(kept + dropped_duplicates)')} AS duplicate_pct FROM stats",
    "corpus_totals": f"""WITH {STATS}, t AS (SELECT CAST(sum(chars_in) AS BIGINT) AS chars_in, CAST(sum(chars_out) AS BIGINT) AS chars_out, CAST(sum(kept) AS BIGINT) AS kept,
      CAST(sum(dropped_short) AS BIGINT) AS dropped_short, CAST(sum(dropped_duplicates) AS BIGINT) AS dropped_duplicates FROM stats)
      SELECT *, {pct('(chars_in - chars_out)', 'chars_in')} AS compression_pct FROM t""",
    "exact_doc_dedup": "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text",
    "bitext_lines": f"""WITH s AS (SELECT instruction AS t FROM qa_merged UNION ALL SELECT output FROM qa_merged WHERE source IS NOT NULL)
      SELECT DISTINCT {strip('t')} AS text FROM s WHERE length({strip('t')}) >= 5""",
    "sft_merge": f"""WITH {PAIRS}, k AS (SELECT pair_id, rank, {norm_key('instruction')} AS norm FROM pairs)
      SELECT pair_id, rank, norm FROM k WHERE norm <> '' QUALIFY row_number() OVER (PARTITION BY norm ORDER BY rank, pair_id) = 1""",
    "sft_source_counts": f"""WITH {PAIRS}, k AS (SELECT coalesce(source, 'unknown') AS source, row_number() OVER (PARTITION BY {norm_key('instruction')} ORDER BY rank, pair_id) AS r FROM pairs WHERE {norm_key('instruction')} <> '')
      SELECT source, count(*) FILTER (r = 1) AS kept, count(*) FILTER (r > 1) AS dropped FROM k GROUP BY source ORDER BY kept DESC, source""",
    "aya_pairs": f"WITH {aya('aya_armenian')} SELECT pair_id, q AS instruction, a AS output FROM judged WHERE reason = 'kept'",
    "aya_skip_reasons": f"WITH {aya('aya_armenian')} SELECT reason, count(*) AS n FROM judged GROUP BY reason",
    "aya_pipeline": f"""WITH sample AS (SELECT * FROM {SAMPLE} WHERE r <= 200), {aya('sample')},
      good AS (SELECT * FROM judged WHERE reason = 'kept' QUALIFY row_number() OVER (PARTITION BY lower(q) ORDER BY pair_id) = 1),
      pool AS (SELECT source, count(*) AS pool FROM sample GROUP BY source), kept AS (SELECT source, count(*) AS kept FROM good GROUP BY source)
      SELECT pool.source, pool, coalesce(kept, 0) AS kept, round(coalesce(kept, 0) * 100 / greatest(pool, 1), 3) AS yield_pct FROM pool LEFT JOIN kept ON pool.source IS NOT DISTINCT FROM kept.source""",
    "source_sample_n": f"SELECT source, pair_id FROM {SAMPLE} WHERE r <= 50",
    "letter_ratio": f"SELECT para_id, CAST(len(regexp_extract_all(text, '[{LETTERS_RE2}]')) AS INTEGER) AS n_script, {ratio('text', 'A-Za-z')} AS latin_ratio FROM corpus_raw WHERE text IS NOT NULL",
    "min_length_filter": f"SELECT para_id, {strip('text')} AS text FROM corpus_raw WHERE length({strip('text')}) >= 50",
    "lang_filter_project": f"SELECT para_id, CAST(octet_length(encode({strip('text')})) + 2 AS INTEGER) AS n_bytes FROM corpus_raw WHERE lang = 'hy' AND length({strip('text')}) >= 50",
    "skip_reason_counts": f"SELECT {reason('text', wiki('text'))} AS reason, count(*) AS n FROM documents GROUP BY 1",
    "wiki_markup_strip": f"SELECT doc_id, {wiki('text')} AS text FROM documents",
    "wiki_markup_marked": f"SELECT pair_id, {wiki(_MARKED)} AS text FROM qa_merged WHERE output IS NOT NULL",
    "html_strip": f"SELECT chunk_id, {HTML} AS text FROM raw_chunks WHERE chunk IS NOT NULL",
    "jsonl_texts": f"""WITH v AS (SELECT chunk_id, {strip("json_extract_string(chunk, '$.body')")} AS text FROM (SELECT * FROM raw_chunks WHERE json_valid(chunk)))
      SELECT chunk_id, text FROM v WHERE length(text) >= 50""",
    "legal_paragraphs": f"""WITH v AS (SELECT chunk_id, {strip("coalesce(json_extract_string(chunk, '$.title'), '')")} AS title, {_BODY} AS body FROM (SELECT * FROM raw_chunks WHERE json_valid(chunk))),
      p AS (SELECT chunk_id, list_filter([title, body], lambda x: x <> '') AS parts FROM v WHERE length(body) >= 100)
      SELECT chunk_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS part, unnest(parts) AS text FROM p""",
    "response_pairs": f"WITH {_RESPONSES} SELECT pair_id, 0 AS pos, q AS instruction, '' AS input, a AS output FROM r WHERE q <> '' AND length(a) > 20",
    "response_arrays": f"WITH {_RESPONSES} SELECT pair_id, 0 AS pos, q AS instruction, '' AS input, a AS output FROM r WHERE q <> '' AND length(a) > 20 AND pair_id % 4 = 1",
    "artifact_filter": f"SELECT doc_id FROM documents WHERE {any_of('text', X.ARTIFACTS)}",
    "blocklist_filter": f"""WITH {PAIRS}, t AS (SELECT pair_id, output, lower(coalesce(instruction, '') || ' ' || coalesce(input, '') || ' ' || coalesce(output, '')) AS t FROM pairs)
      SELECT pair_id FROM t WHERE NOT {any_of('t', X.BLOCKLIST)} AND length(coalesce(output, '')) >= 10""",
    "chat_format": f"WITH {_CHAT} SELECT pair_id, chat FROM chats",
    "chat_extract": f"""WITH {_CHAT} SELECT pair_id, {strip(f"replace(replace(string_split(chat, '{X.ASSISTANT}')[-1], '{X.END}', ''), '{X.USER}', '')")} AS response FROM chats""",
    "fence_strip": f"""WITH {_FENCED} SELECT pair_id, CASE WHEN pair_id % 2 = 0 OR starts_with({strip('t')}, '```') THEN {strip(f"regexp_replace(regexp_replace({strip('t')}, '^```(?:jsonl?)?{WS_RE2}*[\\n]?', ''), '[\\n]?```{WS_RE2}*\\z', '')")} ELSE {strip('t')} END AS text,
      {strip("CASE WHEN contains(t, '```') THEN regexp_replace(string_split(t, '```')[2], '^json', '') ELSE t END")} AS part FROM fenced""",
    "label_normalise": f"WITH {NATIONS} SELECT n_nationkey, CAST(n_regionkey AS INTEGER) AS place FROM nations",
    "mcq_format": f"WITH {NATIONS} SELECT n_nationkey, {_MCQ[0]} AS instruction, {_MCQ[1]} AS output FROM nations",
    "exam_pairs": f"""WITH {NATIONS} SELECT {_EXAM[0]} AS instruction, '' AS input, {_EXAM[1]} AS output, 'armbench/exam_history/mcq' AS source FROM nations WHERE n_nationkey % 4 IN (0, 1)
      UNION ALL SELECT {_FULL}, '', coalesce(label_str, CAST(label_int AS VARCHAR)), 'armbench/exam_history/open' FROM nations WHERE n_nationkey % 4 = 2 AND n_nationkey % 2 = 1
      UNION ALL SELECT 'Տեքստ:' || chr(10) || r_name || chr(10) || chr(10) || 'Հարց: ' || {_FULL}, '', coalesce(label_str, CAST(label_int AS VARCHAR)), 'armbench/exam_history/open' FROM nations WHERE n_nationkey % 4 = 2 AND n_nationkey % 2 = 0""",
    "exam_skipped": f"WITH {NATIONS} SELECT 2 AS task_type, count(*) AS n_skipped FROM nations WHERE n_nationkey % 4 = 3",
    "four_choice_pairs": f"""WITH {NATIONS}, p AS (SELECT *, CASE WHEN label_kind = 'int' AND label_int = 4 THEN 3 WHEN n_nationkey % 3 = 1 AND n_regionkey > 3 THEN NULL WHEN n_nationkey % 3 = 2 AND n_regionkey > 3 THEN NULL ELSE n_regionkey END AS place FROM nations)
      SELECT {_FOUR[0]} AS instruction, '' AS input, {_FOUR[1]} AS output, 'armbench/belebele-in-context-mcqa' AS source FROM p WHERE place IS NOT NULL""",
    "public_service_pairs": f"""WITH {NATIONS}, p AS (SELECT trim(question) AS q, r_name AS a, list_concat([r_name], list_filter(choices, lambda c: c <> r_name)) AS alls FROM nations),
      s AS (SELECT q, a, list_transform(list_sort(list_transform(range(1, 6), lambda i: md5(q || '|' || CAST(i - 1 AS VARCHAR)) || chr(9) || alls[i])), lambda x: string_split(x, chr(9))[2]) AS shuffled FROM p),
      m AS (SELECT *, list_position(shuffled, a) - 1 AS place FROM s)
      SELECT q AS instruction, '' AS input, a AS output, 'armbench/public-services-mcqa/open' AS source FROM p
      UNION ALL SELECT {mcq('q', 'shuffled', 'place', None)[0]}, '', {mcq('q', 'shuffled', 'place', None)[1]}, 'armbench/public-services-mcqa/mcq' FROM m""",
    "open_pairs": f"""SELECT CASE WHEN {strip("coalesce(input, '')")} <> '' THEN 'Տեքստ:' || chr(10) || {strip('input')} || chr(10) || chr(10) || 'Հարց: ' || {strip('instruction')} ELSE {strip('instruction')} END AS instruction,
      '' AS input, {strip('output')} AS output, 'armbench/squad-in-context-qa' AS source FROM armbench_eval WHERE {strip("coalesce(instruction, '')")} <> '' AND {strip("coalesce(output, '')")} <> ''""",
    "resume_anti_join": f"SELECT pair_id FROM aya_armenian WHERE {norm_key('instruction')} NOT IN (SELECT {norm_key('instruction')} FROM qa_merged WHERE output IS NOT NULL)",
    "batch_plan": """WITH plan AS (SELECT printf('topic%02d', n_nationkey) AS topic, CAST(unnest(range(0, 14)) AS INTEGER) AS batch_idx FROM nation)
      SELECT topic, batch_idx, topic || '_' || batch_idx AS batch_key FROM plan WHERE topic || '_' || batch_idx NOT IN (SELECT batch_key FROM armenian_qa_qwen WHERE batch_key IS NOT NULL)""",
    "shard_resume": """WITH n AS (SELECT strftime(fetched_at, '%Y_') || chunk_id || '.parquet' AS name, chunk_id FROM raw_chunks)
      SELECT name FROM n WHERE (starts_with(name, '2023_') OR starts_with(name, '2024_')) AND chunk_id % 3 <> 0""",
    "char_vocab": f"WITH {_CHARS} SELECT token, id FROM vocab",
    "char_encode": f"""WITH {_STREAM}, d AS (SELECT pair_id, list(id ORDER BY i) AS ids FROM stream GROUP BY pair_id), o AS (SELECT pair_id, CASE WHEN output IS NULL THEN NULL ELSE coalesce(ids, []) END AS ids FROM qa_merged LEFT JOIN d USING (pair_id))
      SELECT pair_id, CAST(len(ids) AS INTEGER) AS n, list_reduce(ids, lambda a, x: (a * 31 + x) % 1000003, 0::BIGINT) AS checksum FROM o""",
    "char_decode": f"WITH {_STREAM}, d AS (SELECT pair_id, string_agg(token, '' ORDER BY i) AS text FROM stream GROUP BY pair_id) SELECT pair_id, CASE WHEN output IS NULL THEN NULL ELSE coalesce(d.text, '') END AS text FROM qa_merged LEFT JOIN d USING (pair_id)",
    "vocab_extend": f"""WITH {_CHARS}, tags AS (SELECT unnest(['{X.USER}', '{X.ASSISTANT}', '{X.END}']) AS token, unnest([0, 1, 2]) AS place),
      more AS (SELECT DISTINCT unnest(string_split(chunk, '')) AS token FROM raw_chunks), fresh AS (SELECT token, row_number() OVER (ORDER BY encode(token)) AS r FROM more WHERE token <> '' AND token NOT IN (SELECT token FROM vocab))
      SELECT token, id FROM vocab UNION ALL SELECT token, CAST((SELECT count(*) FROM vocab) + place AS INTEGER) FROM tags UNION ALL SELECT token, CAST((SELECT count(*) FROM vocab) + 2 + r AS INTEGER) FROM fresh""",
    "token_totals": f"WITH {_STREAM} SELECT (SELECT count(*) FROM qa_merged) AS n_rows, count(*) AS n_tokens FROM stream",
    "token_split_90_10": f"""WITH {_STREAM}, cut AS (SELECT CAST(floor(count(*) * (1 - 0.1::DOUBLE)) AS BIGINT) AS cut FROM stream)
      SELECT pair_id, CASE WHEN place < cut THEN 'train' ELSE 'valid' END AS split, min(place) AS start, CAST(count(*) AS INTEGER) AS n FROM stream, cut GROUP BY 1, 2""",
    "pack_blocks": f"""WITH {_STREAM}, b AS (SELECT place // 256 AS block_id, place, id FROM stream UNION ALL SELECT place // 256 - 1, place, id FROM stream WHERE place % 256 = 0 AND place > 0)
      SELECT block_id, arg_min(id, place) AS first_token, arg_max(id, place) AS last_token, CAST(sum(id) AS BIGINT) AS total FROM b GROUP BY block_id HAVING count(*) = 257""",
    "lr_schedule": """WITH s AS (SELECT DISTINCT o_orderkey % 12000 AS step FROM orders)
      SELECT step, round(CASE WHEN step < 500 THEN 3e-4 * step / 500 ELSE 3e-5 + 0.5 * (1 + cos(pi() * least((step - 500) / 9500, 1.0))) * (3e-4 - 3e-5) END, 10) AS lr,
        printf('%02d:%02d:%02d', step // 3600, step % 3600 // 60, step % 60) AS clock, printf('%dm%02ds', step // 60, step % 60) AS minutes FROM s""",
    "running_best": """WITH b AS (SELECT event_id, abs(value) AS loss, min(abs(value)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events)
      SELECT event_id, round(best, 6) AS best_before, best IS NULL OR loss < best AS is_best, round(exp(least(loss, 20.0)), 3) AS perplexity, round(exp(loss / 10), 6) AS uncapped FROM b""",
    "mean_loss": "SELECT event_type, count(value) AS n, round(avg(abs(value)), 6) AS mean_loss FROM events GROUP BY event_type",
    "topk_threshold": """WITH k AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), t AS (SELECT vec_id, v, list_reverse_sort(v)[5] AS kth FROM k)
      SELECT vec_id, CAST(len(list_filter(v, lambda x: x >= kth)) AS INTEGER) AS n, round(kth, 6) AS threshold FROM t""",
}

_PIECES = f"""raw AS (SELECT doc_id, regexp_replace({strip('text')}, '\\r\\n|\\r', chr(10), 'g') AS t FROM documents WHERE text IS NOT NULL AND length({strip('text')}) >= 50),
cut AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'culturax' ELSE 'mc4' END AS source, unnest(string_split_regex(t, '\\n{WS_RE2}*\\n+')) AS p FROM raw)"""
_TAGGED = f"replace(replace(replace(chat, '{X.USER}', chr(57344)), '{X.ASSISTANT}', chr(57345)), '{X.END}', chr(57346))"
_APPROPRIATE = f"""fit AS (SELECT c.pair_id, {_TAGGED} AS t FROM chats c JOIN qa_merged q USING (pair_id)
  WHERE NOT {any_of("lower(coalesce(q.instruction, '') || ' ' || coalesce(q.input, '') || ' ' || coalesce(q.output, ''))", X.BLOCKLIST)} AND length(q.output) >= 10)"""
_PLAIN = "regexp_replace({0}, '[\"\\\\{{}}\\[\\]`\\x00-\\x1f\\x{{7f}}-\\x{{9f}}\\x{{2028}}\\x{{2029}}]', ' ', 'g')"
#: Queries over files that they write themselves, and others that the tables alone don't show.
FILES: dict[str, str] = {
    "wiki_articles_xml": f"""WITH p AS (SELECT pair_id % 5 AS ns, {lit("'''Վերնագիր''' ")} || output || ' [[File:a.jpg|b]] {{{{t}}}}' AS raw FROM qa_merged WHERE output IS NOT NULL AND NOT regexp_matches(output, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\r\\x{{fffe}}\\x{{ffff}}]'))
      SELECT 'wiki' AS source, {wiki('raw')} AS text FROM p WHERE ns = 0 AND length(raw) >= 200 AND length({wiki('raw')}) > 100""",
    "zstd_json_texts": f"SELECT {strip('text')} AS text FROM corpus_raw WHERE length({strip('text')}) >= 50",
    "xz_documents": f"""WITH p AS (SELECT unnest(string_split_regex(chr(10) || chr(10) || regexp_replace(output, '\\r\\n|\\r', chr(10), 'g') || chr(10) || chr(10), '\\n{WS_RE2}*\\n+')) AS paragraph FROM qa_merged WHERE output IS NOT NULL)
      SELECT paragraph FROM p WHERE length(paragraph) >= 50""",
    "source_registry": f"""WITH t AS (SELECT {strip('text')} AS text, lang FROM corpus_raw), s AS (SELECT 'mc4' AS source, text FROM t UNION ALL SELECT 'finetranslations', text FROM t UNION ALL SELECT 'ccnews', text FROM t WHERE lang = 'hy')
      SELECT source, count(*) AS n_texts, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM s WHERE length(text) >= 50 GROUP BY source""",
    "first_split_rows": "SELECT item_id FROM armbench_train",
    "pairs_array": "SELECT CAST(row_number() OVER (ORDER BY pair_id) - 1 AS INTEGER) AS pos, pair_id, instruction, input, output FROM qa_merged",
    "merged_text": f"SELECT regexp_replace({clean('text')}, '\\n+', ' ', 'g') AS text FROM corpus_raw WHERE {clean('text')} <> ''",
    "stats_file": f"""WITH {STATS} SELECT CAST(sum(chars_in) AS BIGINT) AS chars_in, CAST(sum(chars_out) AS BIGINT) AS chars_out, CAST(sum(kept) AS BIGINT) AS kept,
      CAST(sum(dropped_short) AS BIGINT) AS dropped_short, CAST(sum(dropped_duplicates) AS BIGINT) AS dropped_duplicates, count(*) AS n_sources FROM stats""",
    "pairs_in_files": "SELECT 'qa_merged' AS name, count(*) AS n_pairs FROM qa_merged UNION ALL SELECT 'aya_armenian', count(*) FROM aya_armenian",
    "token_bin_blocks": f"WITH {_STREAM} SELECT count(*) AS n_tokens, CAST(sum(id) AS BIGINT) AS total, CAST(sum(CAST(id AS BIGINT) * id) AS BIGINT) AS squares, count(*) AS n_written FROM stream",
    "vocabulary_file": f"WITH {_CHARS} SELECT token, id FROM vocab",
    "manifest_resume": "SELECT DISTINCT batch_key FROM armenian_qa_qwen WHERE batch_key IS NOT NULL AND right(batch_key, 1) NOT IN ('1', '2')",
    "orphan_files": "SELECT chunk_id FROM raw_chunks WHERE chunk_id % 4 = 1",
    "data_files": "WITH n AS (SELECT pair_id, coalesce(source, 'none') || ['.json', '_progress.json', '.txt'][CAST(pair_id % 3 + 1 AS INTEGER)] AS name FROM qa_merged) SELECT pair_id, name FROM n WHERE regexp_matches(name, '[.]json$') AND NOT regexp_matches(name, '_progress[.]json$')",
    "transient_errors": "SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'rate|429|overloaded|busy|500|502|503|504|inference error|timeout')",
    "batch_prompts": """WITH plan AS (SELECT n_name AS topic, CAST(unnest(range(0, 2)) AS INTEGER) AS batch_idx FROM nation)
      SELECT topic, batch_idx, 'Write about ' || topic || ', part ' || (batch_idx + 1) || ': ' || topic || '!' AS prompt FROM plan""",
    "first_pairs": "SELECT pair_id, instruction FROM qa_merged ORDER BY pair_id LIMIT 3",
    "run_throughput": """WITH e AS (SELECT event_id, user_id, CAST(event_id % 7 + 1 AS DOUBLE) AS s FROM events),
      w AS (SELECT event_id, sum(s) OVER r AS spent, count(*) OVER r * 512 AS n FROM e WINDOW r AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
      SELECT event_id, round(n / spent, 6) AS tokens_per_s, round(spent / (event_id + 1) * (10000 - event_id - 1), 3) AS seconds_left FROM w""",
    "chat_tokens": f"""WITH {_CHARS}, {_CHAT}, tags AS (SELECT unnest([chr(57344), chr(57345), chr(57346)]) AS token, unnest([0, 1, 2]) AS place),
      all_tokens AS (SELECT token, id FROM vocab UNION ALL SELECT token, CAST((SELECT count(*) FROM vocab) + place AS INTEGER) FROM tags),
      pieces AS (SELECT pair_id, unnest(string_split({_TAGGED}, '')) AS token, generate_subscripts(string_split({_TAGGED}, ''), 1) AS i FROM chats),
      d AS (SELECT pair_id, list(id ORDER BY i) AS ids, string_agg(token, '' ORDER BY i) AS back FROM pieces JOIN all_tokens USING (token) GROUP BY pair_id)
      SELECT pair_id, CAST(len(ids) AS INTEGER) AS n, list_reduce(ids, lambda a, x: (a * 31 + x) % 1000003, 0::BIGINT) AS checksum,
        replace(replace(replace(back, chr(57344), '{X.USER}'), chr(57345), '{X.ASSISTANT}'), chr(57346), '{X.END}') AS back FROM d""",
    "piece_round_trip": f"""WITH {_CHAT} SELECT pair_id, chat AS text, CAST(len(regexp_extract_all(chat, '<\\|(?:user|assistant|end)\\|>')) AS INTEGER) AS n_tags, 32000 AS first_tag, 32002 AS last_tag FROM chats""",
    "benchmark_union": f"""WITH {NATIONS}, p AS (SELECT *, CASE WHEN label_kind = 'int' AND label_int = 4 THEN 3 WHEN n_nationkey % 3 = 1 AND n_regionkey > 3 THEN NULL WHEN n_nationkey % 3 = 2 AND n_regionkey > 3 THEN NULL ELSE n_regionkey END AS place FROM nations),
      exam AS (SELECT {_EXAM[0]} AS instruction, {_EXAM[1]} AS output, 'mcq' AS kind FROM nations WHERE n_nationkey % 4 IN (0, 1)
        UNION ALL SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'Տեքստ:' || chr(10) || r_name || chr(10) || chr(10) || 'Հարց: ' ELSE '' END || {_FULL}, coalesce(label_str, CAST(label_int AS VARCHAR)), 'open' FROM nations WHERE n_nationkey % 4 = 2)
      SELECT 'train' AS side, 'armbench/' || config || '/' || kind AS source, instruction, output FROM exam, (SELECT unnest(['exam_history', 'exam_math']) AS config)
      UNION ALL SELECT 'train', 'armbench/include-mcqa', {mcq("question", "choices[1:4]", "place", None)[0]}, {mcq("question", "choices[1:4]", "place", None)[1]} FROM p WHERE place IS NOT NULL
      UNION ALL SELECT 'eval', 'armbench/simpleqa', {strip('instruction')}, {strip('output')} FROM armbench_eval WHERE {strip("coalesce(instruction, '')")} <> '' AND {strip("coalesce(output, '')")} <> ''""",
    "instruction_files": f"""WITH {PAIRS}, k AS (SELECT *, {norm_key('instruction')} AS norm FROM pairs)
      SELECT norm, source, output FROM k WHERE norm <> '' QUALIFY row_number() OVER (PARTITION BY norm ORDER BY rank, pair_id) = 1""",
    "chat_dataset": f"""WITH {_CHAT}, {_APPROPRIATE}, n AS (SELECT CAST(sum(length(t)) + count(*) - 1 AS BIGINT) AS n FROM fit)
      SELECT 'train' AS split, CAST(floor(n * (1 - 0.1::DOUBLE)) AS BIGINT) AS n_tokens FROM n UNION ALL SELECT 'valid', n - CAST(floor(n * (1 - 0.1::DOUBLE)) AS BIGINT) FROM n""",
    "token_dataset": """WITH n AS (SELECT CAST(sum(length(output)) AS BIGINT) AS n FROM qa_merged)
      SELECT 'train' AS split, CAST(floor(n * (1 - 0.1::DOUBLE)) AS BIGINT) AS n_tokens, 'char' AS kind FROM n UNION ALL SELECT 'valid', n - CAST(floor(n * (1 - 0.1::DOUBLE)) AS BIGINT), 'char' FROM n""",
    "prepared_corpus": f"""WITH {_PIECES}, c AS (SELECT source, doc_id, length(p) AS chars_in, {clean('p')} AS clean FROM cut WHERE length(p) >= 50),
      f AS (SELECT *, CASE WHEN length(clean) < 50 THEN 'short' WHEN row_number() OVER (PARTITION BY clean ORDER BY source, doc_id) = 1 THEN 'kept' ELSE 'duplicate' END AS fate FROM c),
      agg AS (SELECT source, CAST(sum(chars_in) AS BIGINT) AS chars_in, CAST(sum(CASE WHEN fate = 'kept' THEN length(clean) + 2 ELSE 0 END) AS BIGINT) AS chars_out,
        count(*) FILTER (fate = 'kept') AS kept, count(*) FILTER (fate = 'short') AS dropped_short, count(*) FILTER (fate = 'duplicate') AS dropped_duplicates FROM f GROUP BY source),
      o AS (SELECT unnest(['wiki', 'wikisource', 'wiktionary', 'wikiquote', 'arlis', 'ccnews', 'glot500', 'hplt3', 'culturax', 'finetranslations', 'mc4', 'cc100']) AS source, unnest(range(1, 13)) AS priority),
      s AS (SELECT o.source, CAST(o.priority AS INTEGER) AS priority, CASE WHEN kept IS NULL THEN 'missing' ELSE 'ok' END AS status, coalesce(chars_in, 0) AS chars_in, coalesce(chars_out, 0) AS chars_out,
        coalesce(kept, 0) AS kept, coalesce(dropped_short, 0) AS dropped_short, coalesce(dropped_duplicates, 0) AS dropped_duplicates FROM o LEFT JOIN agg USING (source))
      SELECT *, {pct('(chars_in - chars_out)', 'chars_in')} AS compression_pct, {pct('dropped_duplicates', '(kept + dropped_duplicates)')} AS duplicate_pct FROM s""",
    "response_tiers": f"""WITH r AS (SELECT pair_id, {ws_clean(_PLAIN.format('instruction'))} AS q, {ws_clean(_PLAIN.format('output'))} AS a FROM armenian_qa_qwen),
      g AS (SELECT *, unnest(CASE WHEN pair_id % 5 = 2 THEN [1, 2] ELSE [1, 2, 3] END) AS n FROM r WHERE q <> '' AND length(a) > 20)
      SELECT pair_id, CAST(n - 1 AS INTEGER) AS pos, q || ' ' || n AS instruction, a AS output FROM g""",
}
ORACLE |= FILES
