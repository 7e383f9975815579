"""SQL oracles (DuckDB dialect) for the registered plans.

Written independently of the Spark plans: plain global ``row_number`` where
Spark uses bucketed ranks, CASE chains where Spark compiles ``greatest``
over structs, ``quantile_cont`` / ``stddev_samp`` where Spark derives the
statistics from a length histogram.  Tables are the pre-registered views.
"""

from __future__ import annotations

from ..functions.constants import (
    CLASSIFIER_TRAIN_ROWS, DEFAULT_BANK_TEMPLATES, DEFAULT_QUESTIONS, EMPTY_MESSAGE_NOTICE, FALLBACK_INTENT, MODEL_PROMPT_PREFIX,
    NO_PLACEHOLDER_PREFIX, NO_PLACEHOLDER_SEPARATOR, STOCK_LEXICON,
)
from ..functions.lexicon import PROBE_LEXICON


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def h(key: str, seed: int = 42) -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR)))"


TOKENS = "coalesce(list_filter(regexp_split_to_array(lower({x}), '[ \t\n\r\f]+'), lambda t: t <> ''), [])"

CORPUS = """corpus AS (
  SELECT doc_id AS id,
         CASE WHEN split_part(text, chr(10), 1) <> text THEN split_part(text, chr(10), 1) END AS instruction,
         text AS response, upper(lang) AS category, source AS intent
  FROM documents)"""

CLEAN = CORPUS + """,
clean AS (
  SELECT id, instruction, response, category, intent FROM (
    SELECT *, row_number() OVER (PARTITION BY instruction, response ORDER BY id) AS rn
    FROM corpus WHERE instruction IS NOT NULL AND response IS NOT NULL) WHERE rn = 1)"""

SPLIT = CLEAN + f""",
ranked AS (
  SELECT *, row_number() OVER (ORDER BY {h('id')}, id) AS r, count(*) OVER () AS n FROM clean),
split AS (
  SELECT id, instruction AS input_text, response AS target_text, category, intent,
    CASE WHEN r <= ceil(n * 0.1::DOUBLE) THEN 'test'
         WHEN r <= ceil(n * 0.1::DOUBLE)
                   + ceil((0.1::DOUBLE / (1 - 0.1::DOUBLE)) * (n - ceil(n * 0.1::DOUBLE))) THEN 'val'
         ELSE 'train' END AS split
  FROM ranked),
train AS (SELECT * FROM split WHERE split = 'train')"""

BANK = SPLIT + f""",
bank AS (
  SELECT intent, list(target_text ORDER BY hh, id) AS templates FROM (
    SELECT intent, target_text, id, {h('id')} AS hh,
           row_number() OVER (PARTITION BY intent ORDER BY {h('id')}, id) AS rk
    FROM train WHERE intent IS NOT NULL) WHERE rk <= 5 GROUP BY intent)"""

QUESTIONS = "q AS (SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user')"


def intent_sql(lexicon, x: str = "query") -> tuple[str, str]:
    """(intent expression, score expression) as CASE chains."""
    scores = []
    for _, kws in lexicon:
        scores.append("(" + " + ".join(
            f"CASE WHEN contains(lower({x}), {lit(k)}) THEN 1 ELSE 0 END" for k in kws) + ")")
    m = "greatest(" + ", ".join(scores) + ")" if len(scores) > 1 else scores[0]
    whens = " ".join(f"WHEN {s} = {m} THEN {lit(i)}" for s, (i, _) in zip(scores, lexicon))
    return f"CASE WHEN coalesce({m}, 0) = 0 THEN {lit(FALLBACK_INTENT)} {whens} END", f"coalesce({m}, 0)"


def answer_ctes(lexicon, use_templates: bool = True, src: str = "q", extra: str = "") -> str:
    """CTEs ``cls, look, ans, answered`` answering ``query`` of CTE ``src``
    against CTE ``bank``; ``extra`` lists pass-through columns."""
    intent, _ = intent_sql(lexicon)
    pick = "tpl[(('0x' || substr(md5(concat_ws('|', '42', query)), 1, 8))::BIGINT % len(tpl)) + 1]"
    use = "TRUE" if use_templates else "FALSE"
    return f"""cls AS (SELECT *, {intent} AS _intent FROM {src}),
look AS (
  SELECT cls.*, coalesce(b.templates,
         (SELECT templates FROM bank WHERE intent = {lit(FALLBACK_INTENT)} LIMIT 1)) AS tpl
  FROM cls LEFT JOIN bank b ON b.intent = cls._intent),
ans AS (
  SELECT *, CASE WHEN query IS NULL OR query = '' THEN 'guard'
                 WHEN {use} AND coalesce(len(tpl), 0) > 0 THEN 'template' ELSE 'model' END AS route,
         CASE WHEN coalesce(len(tpl), 0) > 0 THEN {pick} END AS t
  FROM look),
answered AS (
SELECT conv_id, turn, {extra} query, CASE WHEN route <> 'guard' THEN _intent END AS intent, route,
  CASE WHEN route = 'guard' THEN {lit(EMPTY_MESSAGE_NOTICE)}
       WHEN route = 'template' THEN
         CASE WHEN contains(t, '{{query}}') THEN replace(t, '{{query}}', query)
              ELSE {lit(NO_PLACEHOLDER_PREFIX)} || query || {lit(NO_PLACEHOLDER_SEPARATOR)} || t END
  END AS response,
  CASE WHEN route = 'model' THEN {lit(MODEL_PROMPT_PREFIX)} || query END AS prompt
FROM ans)"""


def answers_sql(lexicon, bank_cte: str, use_templates: bool = True) -> str:
    return (f"WITH {bank_cte}, {QUESTIONS},\n{answer_ctes(lexicon, use_templates)}\n"
            "SELECT conv_id, turn, query, intent, route, response, prompt FROM answered")


EVENTS = f"""ev AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'system' ELSE role END AS role,
  CASE WHEN turn % 5 <> 4 AND substr(md5(concat_ws('|', '42', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR))), 1, 1)
            IN ('0', '1', '2') THEN '' ELSE text END AS text FROM conversations)"""


def history_sql(lexicon, turns: str = "conversations", extra: str = "") -> str:
    """Rows of the per-conversation history: recorded user turns with their
    1-based position since the last clear (system turn)."""
    src = "qh AS (SELECT conv_id, turn, role, text AS query FROM " + turns + " WHERE role IN ('user', 'system'))"
    return f"""WITH {BANK}, {extra}{src},
{answer_ctes(lexicon, True, "qh", "role,")},
seg AS (SELECT *, sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS s FROM answered),
pos AS (SELECT *, sum(CASE WHEN role = 'user' AND route <> 'guard' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY conv_id, s ORDER BY turn ROWS UNBOUNDED PRECEDING) AS history_pos FROM seg)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, CAST(history_pos AS BIGINT) AS history_pos,
       query AS message, response
FROM pos WHERE role = 'user' AND route <> 'guard'"""


DEFAULT_BANK = ("bank AS (SELECT 'general' AS intent, ["
                + ", ".join(lit(t) for t in DEFAULT_BANK_TEMPLATES) + "] AS templates)")

PROFILED = CORPUS + """,
prof AS (SELECT *, CAST(length(instruction) AS BIGINT) AS instruction_length,
                   CAST(length(response) AS BIGINT) AS response_length FROM corpus)"""

PROF_COLS = ["id", "instruction", "response", "category", "intent", "instruction_length", "response_length"]

VALUES = PROFILED + ",\nvals AS (" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM prof" for c in PROF_COLS) + ")"

LENGTHS = CORPUS + """,
lens AS (
  SELECT 'instruction' AS field, CAST(length(instruction) AS BIGINT) AS len FROM corpus WHERE instruction IS NOT NULL
  UNION ALL
  SELECT 'response', CAST(length(response) AS BIGINT) FROM corpus WHERE response IS NOT NULL)"""

VOCAB = SPLIT + f""",
toks AS (SELECT unnest(list_concat({TOKENS.format(x='input_text')}, {TOKENS.format(x='target_text')})) AS token
         FROM train),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id, n FROM (
    SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 50261))"""


def encoded_sql(src: str = "train", prefix: str = "", carry: str = "") -> str:
    def ids(col: str, length: int, name: str) -> str:
        return f"""{name}_t AS (SELECT id, list_slice({TOKENS.format(x=col)}, 1, {length - 2}) AS tl FROM {src}),
{name}_u AS (SELECT id, unnest(tl) AS w, unnest(range(1, len(tl) + 1)) AS p FROM {name}_t),
{name}_g AS (SELECT u.id, list(coalesce(v.id, 3) ORDER BY u.p) AS body
             FROM {name}_u u LEFT JOIN vocab v ON v.token = u.w GROUP BY u.id),
{name} AS (SELECT t.id, list_concat([0], coalesce(g.body, []), [2]) AS core
           FROM {name}_t t LEFT JOIN {name}_g g ON g.id = t.id)"""

    return f"""WITH {VOCAB},{prefix}
{ids('input_text', 128, 'ei')},
{ids('target_text', 512, 'et')}
SELECT ei.id,{" s.split," if carry else ""}
  array_to_string(list_concat(ei.core, list_transform(range(128 - len(ei.core)), lambda x: 1)), ',') AS input_ids,
  array_to_string(list_concat(list_transform(ei.core, lambda x: 1),
                              list_transform(range(128 - len(ei.core)), lambda x: 0)), ',') AS attention_mask,
  array_to_string(list_concat(et.core, list_transform(range(512 - len(et.core)), lambda x: -100)), ',') AS labels
FROM ei JOIN et ON et.id = ei.id{" JOIN split s ON s.id = ei.id" if carry else ""}"""


def _hist_sql() -> str:
    return "WITH " + LENGTHS + """,
rng AS (SELECT field,
          CASE WHEN min(len) = max(len) THEN min(len) - 0.5 ELSE CAST(min(len) AS DOUBLE) END AS lo,
          CASE WHEN min(len) = max(len) THEN max(len) + 0.5 ELSE CAST(max(len) AS DOUBLE) END AS hi
        FROM lens GROUP BY field),
b0 AS (SELECT l.field, CAST(l.len AS DOUBLE) AS x, r.lo, r.hi, (r.hi - r.lo) / 50 AS step,
         least(floor((CAST(l.len AS DOUBLE) - r.lo) * 50 / (r.hi - r.lo)), 49) AS i0
       FROM lens l JOIN rng r USING (field)),
b1 AS (SELECT *, CASE WHEN x < lo + i0 * step THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT field, CASE WHEN i1 < 49 AND x >= lo + (i1 + 1) * step THEN i1 + 1 ELSE i1 END AS bin FROM b1),
cnt AS (SELECT field, CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b2 GROUP BY ALL),
grid AS (SELECT field, lo, hi, (hi - lo) / 50 AS step, CAST(unnest(range(50)) AS INTEGER) AS bin FROM rng)
SELECT g.field, g.bin, round(g.lo + g.bin * g.step, 6) AS lo_edge,
       round(CASE WHEN g.bin = 49 THEN g.lo + 50 * g.step ELSE g.lo + (g.bin + 1) * g.step END, 6) AS hi_edge,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN cnt c ON c.field = g.field AND c.bin = g.bin"""


def _classify(lexicon) -> str:
    intent, score = intent_sql(lexicon)
    return f"WITH {QUESTIONS} SELECT conv_id, turn, {intent} AS intent, CAST({score} AS INTEGER) AS score FROM q"


def _types_sql() -> str:
    mapping = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' " \
              "WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END"
    return (f"SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name AS field, {mapping} AS type "
            f"FROM (DESCRIBE WITH {PROFILED} SELECT * FROM prof)")


def _typed_sql() -> str:
    return (f"WITH {VALUES}, t AS ({_types_sql()}) SELECT t.position, t.field, t.type, count(v.value) AS non_null "
            "FROM t JOIN vals v ON v.field = t.field GROUP BY ALL")


ORACLES: dict[str, str] = {
    "format_pairs": f"WITH {CORPUS} SELECT id, instruction AS input_text, response AS target_text, category, intent FROM corpus",
    "drop_missing": f"WITH {CORPUS} SELECT * FROM corpus WHERE instruction IS NOT NULL AND response IS NOT NULL",
    "dedup_pairs": f"WITH {CLEAN} SELECT * FROM clean",
    "label_vocabulary": f"""WITH {SPLIT},
v AS (SELECT 'category' AS field, category AS value, min(id) AS k FROM train GROUP BY category
      UNION ALL SELECT 'intent', intent, min(id) FROM train GROUP BY intent)
SELECT field, value, CAST(row_number() OVER (PARTITION BY field ORDER BY k) AS BIGINT) AS position FROM v""",
    "preview": f"WITH {CORPUS} SELECT id, instruction, category, intent FROM corpus ORDER BY id LIMIT 5",
    "split_train_val_test": f"WITH {SPLIT} SELECT id, category, intent, split FROM split",
    "split_sizes": f"WITH {SPLIT} SELECT split, count(*) AS rows, '0.8/0.1/0.1' AS shares FROM split GROUP BY split",
    "split_metadata": f"""WITH {SPLIT}
SELECT count(*) AS clean_size,
  CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_size,
  CAST(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_size,
  CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS test_size,
  (SELECT count(*) FROM corpus) AS raw_size,
  'input_text,target_text,category,intent' AS columns
FROM split""",
    "sample_questions": f"""WITH {CLEAN}
SELECT id, instruction, CAST(row_number() OVER (ORDER BY {h('id')}, id) AS INTEGER) AS pos
FROM (SELECT * FROM clean ORDER BY {h('id')}, id LIMIT 10)""",
    "sample_train_rows": f"WITH {SPLIT} SELECT id, intent FROM train ORDER BY {h('id')}, id LIMIT 100",
    "shuffle_take": f"""WITH l AS (SELECT d.doc_id AS idx, lb.quality AS label FROM documents d JOIN labels lb ON lb.doc_id = d.doc_id)
SELECT idx, label, CAST(row_number() OVER (ORDER BY {h('idx')}, idx) AS INTEGER) AS shuffle_pos
FROM (SELECT * FROM l ORDER BY {h('idx')}, idx LIMIT 1000)""",
    "sample_per_group": f"""WITH {SPLIT}
SELECT intent, id, rank FROM (
  SELECT intent, id, CAST(row_number() OVER (PARTITION BY intent ORDER BY {h('id')}, id) AS INTEGER) AS rank
  FROM train WHERE intent IS NOT NULL) WHERE rank <= 5""",
    "shape": f"WITH {PROFILED} SELECT count(*) AS rows, CAST(7 AS BIGINT) AS columns FROM prof",
    "column_types": _typed_sql(),
    "distinct_counts": f"WITH {VALUES} SELECT field, count(DISTINCT value) AS distinct FROM vals GROUP BY field",
    "top_values": f"""WITH {VALUES},
vc AS (SELECT field, value, count(*) AS n FROM vals WHERE value IS NOT NULL GROUP BY ALL),
dc AS (SELECT field, count(*) AS d FROM vc GROUP BY field)
SELECT field, rank, value, n FROM (
  SELECT vc.field, CAST(row_number() OVER (PARTITION BY vc.field ORDER BY n DESC, value) AS INTEGER) AS rank,
         value, n
  FROM vc JOIN dc USING (field) WHERE dc.field IN ('category', 'intent') OR dc.d < 20) WHERE rank <= 10""",
    "category_counts": f"WITH {CORPUS} SELECT category, count(*) AS n FROM corpus WHERE category IS NOT NULL GROUP BY category",
    "intent_counts": f"WITH {CORPUS} SELECT intent, count(*) AS n FROM corpus WHERE intent IS NOT NULL GROUP BY intent",
    "length_stats": f"""WITH {LENGTHS}
SELECT field, count(*) AS count, round(avg(len), 6) AS mean, round(stddev_samp(len), 6) AS std,
  round(CAST(min(len) AS DOUBLE), 6) AS min, round(quantile_cont(len, 0.25), 6) AS p25,
  round(quantile_cont(len, 0.5), 6) AS p50, round(quantile_cont(len, 0.75), 6) AS p75,
  round(CAST(max(len) AS DOUBLE), 6) AS max
FROM lens GROUP BY field""",
    "length_histogram": _hist_sql(),
    "profile_report": f"""WITH {VALUES},
t AS ({_types_sql()})
SELECT 'shape' AS section, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value, 1 AS ord FROM prof
UNION ALL SELECT 'shape', 'columns', '7', 2
UNION ALL SELECT 'type', field, type, position FROM t
UNION ALL SELECT 'distinct', v.field, CAST(count(DISTINCT v.value) AS VARCHAR), min(t.position)
  FROM vals v JOIN t ON t.field = v.field GROUP BY v.field""",
    "template_bank": f"""WITH {BANK}
SELECT intent, CAST(len(templates) AS BIGINT) AS n_templates, array_to_string(templates, ' || ') AS templates_text
FROM bank""",
    "general_bank": f"""WITH {SPLIT}
SELECT 'general' AS intent, CAST(count(*) AS BIGINT) AS n_templates,
       string_agg(target_text, ' || ' ORDER BY hh, id) AS templates_text
FROM (SELECT id, target_text, {h('id')} AS hh FROM train ORDER BY {h('id')}, id LIMIT 20)""",
    "classify_intent": _classify(STOCK_LEXICON),
    "classify_intent_probe": _classify(PROBE_LEXICON),
    "classify_intent_join": _classify(PROBE_LEXICON),
    "classify_intent_lexicon": f"""WITH {QUESTIONS},
lex AS (SELECT keyword, CAST(('0x' || substr(md5(keyword), 1, 6))::BIGINT % 50 AS INTEGER) AS place FROM (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS keyword FROM documents)),
hits AS (SELECT conv_id, turn, place, CAST(count(*) AS INTEGER) AS score FROM q JOIN lex ON contains(lower(query), keyword) GROUP BY ALL),
best AS (SELECT conv_id, turn, arg_max(place, score * 100 - place) AS place, max(score) AS score FROM hits GROUP BY ALL)
SELECT conv_id, turn, coalesce('topic' || place, 'general') AS intent, coalesce(score, 0) AS score FROM q LEFT JOIN best USING (conv_id, turn)""",
    "answer_questions": answers_sql(STOCK_LEXICON, BANK),
    "answer_questions_probe": answers_sql(PROBE_LEXICON, BANK),
    "answer_default_bank": answers_sql(STOCK_LEXICON, DEFAULT_BANK),
    "answer_model_only": answers_sql(PROBE_LEXICON, BANK, use_templates=False),
    "side_by_side": (
        "SELECT conv_id, turn, intent, route AS template_route, response AS template_response, "
        f"CASE WHEN query IS NULL OR query = '' THEN NULL ELSE {lit(MODEL_PROMPT_PREFIX)} || query END AS model_prompt "
        "FROM (" + answers_sql(PROBE_LEXICON, BANK) + ")"),
    "inference_table": f"""WITH {SPLIT}
SELECT id, CAST(row_number() OVER (ORDER BY {h('id')}, id) AS INTEGER) AS pos,
       input_text AS input, target_text AS target, {lit(MODEL_PROMPT_PREFIX)} || input_text AS prompt
FROM (SELECT * FROM split WHERE split = 'test' ORDER BY {h('id')}, id LIMIT 10)""",
    "build_vocabulary": f"WITH {VOCAB} SELECT token, id, n FROM vocab",
    "encode_pairs": encoded_sql(),
    "latency_summary": """SELECT
  round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS avg_template_time,
  round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS avg_model_time,
  count(CASE WHEN event_type = 'click' THEN 1 END) AS template_rows,
  count(CASE WHEN event_type = 'view' THEN 1 END) AS model_rows,
  round(CASE WHEN avg(CASE WHEN event_type = 'click' THEN value END) > 0
             THEN avg(CASE WHEN event_type = 'view' THEN value END)
                  / avg(CASE WHEN event_type = 'click' THEN value END) ELSE 0 END, 6) AS speedup_factor
FROM events""",
    "latency_by_path": "SELECT event_type AS path, count(*) AS rows, round(avg(value), 6) AS avg_seconds FROM events GROUP BY event_type",
    "run_speedup": """SELECT round(avg(CASE WHEN event_type = 'purchase' THEN value END), 6) AS avg_before,
  round(avg(CASE WHEN event_type = 'signup' THEN value END), 6) AS avg_after,
  'purchase' AS run_before, 'signup' AS run_after,
  round(CASE WHEN avg(CASE WHEN event_type = 'signup' THEN value END) > 0
             THEN avg(CASE WHEN event_type = 'purchase' THEN value END)
                  / avg(CASE WHEN event_type = 'signup' THEN value END) ELSE 0 END, 6) AS speedup
FROM events WHERE event_type IN ('purchase', 'signup')""",
    "accuracy": """SELECT round(avg(CASE WHEN list_position(embedding, list_max(embedding)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) AS rows FROM embeddings""",
    "response_info": """SELECT user_id, round(arg_max(value, event_id), 6) AS last_seconds,
  printf('Response time: %.2f seconds', arg_max(value, event_id)) AS info FROM events GROUP BY user_id""",
}


def _labelled_sql() -> str:
    enc_cols = "idx"
    return f"""WITH l AS (SELECT d.doc_id AS idx, d.text AS sentence, lb.quality AS label
           FROM documents d JOIN labels lb ON lb.doc_id = d.doc_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY {h('idx')}, idx) AS r, count(*) OVER () AS n FROM l),
sp AS (SELECT idx, sentence, label,
    CASE WHEN r <= ceil(n * 0.1::DOUBLE) THEN 'test'
         WHEN r <= ceil(n * 0.1::DOUBLE)
                   + ceil((0.1::DOUBLE / (1 - 0.1::DOUBLE)) * (n - ceil(n * 0.1::DOUBLE))) THEN 'val'
         ELSE 'train' END AS split FROM ranked),
tr AS (SELECT *, row_number() OVER (ORDER BY {h('idx')}, idx) AS shuffle_pos FROM sp WHERE split = 'train'),
va AS (SELECT *, row_number() OVER (ORDER BY {h('idx')}, idx) AS shuffle_pos FROM sp WHERE split = 'val'),
sub AS (SELECT * FROM tr UNION ALL SELECT * FROM va),
toks AS (SELECT unnest({TOKENS.format(x='sentence')}) AS token FROM tr),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id, n FROM (
    SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 50261)),
e_t AS (SELECT {enc_cols}, list_slice({TOKENS.format(x='sentence')}, 1, 126) AS tl FROM sub),
e_u AS (SELECT idx, unnest(tl) AS w, unnest(range(1, len(tl) + 1)) AS p FROM e_t),
e_g AS (SELECT u.idx, list(coalesce(v.id, 3) ORDER BY u.p) AS body
        FROM e_u u LEFT JOIN vocab v ON v.token = u.w GROUP BY u.idx),
e AS (SELECT t.idx, list_concat([0], coalesce(g.body, []), [2]) AS core FROM e_t t LEFT JOIN e_g g ON g.idx = t.idx)
SELECT sub.split, CAST(sub.shuffle_pos AS BIGINT) AS shuffle_pos,
  array_to_string(list_concat(e.core, list_transform(range(128 - len(e.core)), lambda x: 1)), ',') AS input_ids,
  array_to_string(list_concat(list_transform(e.core, lambda x: 1),
                              list_transform(range(128 - len(e.core)), lambda x: 0)), ',') AS attention_mask,
  sub.label AS labels
FROM sub JOIN e ON e.idx = sub.idx"""


def _battery_sql() -> str:
    hq = "md5(concat_ws('|', '42', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)))"
    src = f"""qb AS (SELECT conv_id, turn, query, CAST(row_number() OVER (ORDER BY {hq}, conv_id, turn) AS INTEGER) AS pos
       FROM (SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user'
             ORDER BY {hq}, conv_id, turn LIMIT 19))"""
    return f"""WITH {BANK}, {src},
{answer_ctes(PROBE_LEXICON, True, "qb", "pos,")}
SELECT pos, query, intent, route AS template_route, response AS template_response,
  CASE WHEN pos <= 5 AND NOT (query IS NULL OR query = '') THEN {lit(MODEL_PROMPT_PREFIX)} || query END AS model_prompt
FROM answered"""


def _numbered_sql() -> str:
    return f"""WITH {CLEAN},
s AS (SELECT instruction, id AS pos FROM clean),
l AS (SELECT CAST(pos AS VARCHAR) || '. ' || instruction AS value FROM s),
st AS (SELECT value, regexp_replace(value, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') AS v FROM l)
SELECT value, CASE WHEN strpos(v, '. ') > 0 THEN substr(v, strpos(v, '. ') + 2) ELSE v END AS question FROM st"""


def _response_log_sql() -> str:
    return f"""WITH e AS (
  SELECT event_type AS run, 'event ' || CAST(event_id AS VARCHAR) AS query, props AS response, value AS response_time,
         row_number() OVER (PARTITION BY event_type ORDER BY {h('event_id')}, event_id) AS pos,
         avg(value) OVER (PARTITION BY event_type) AS avg_response_time,
         count(*) OVER (PARTITION BY event_type) AS responses_total
  FROM events)
SELECT run, CAST(pos AS BIGINT) AS pos, query, response, round(response_time, 6) AS response_time,
       round(avg_response_time, 6) AS avg_response_time, responses_total
FROM e"""


ORACLES.update({
    "csv_roundtrip": f"WITH {SPLIT} SELECT id, input_text, target_text, category, intent, split FROM split",
    "csv_split_roundtrip": f"WITH {SPLIT} SELECT id, input_text, target_text, category, intent FROM split",
    "csv_quarantine": f"""WITH {CLEAN} SELECT CASE WHEN id % 7 = 0 THEN 'too few fields' WHEN id % 11 = 0 THEN 'value of another type' ELSE 'read' END AS reason,
  count(*) AS records FROM clean GROUP BY 1""",
    "json_quarantine": """SELECT CASE WHEN event_id % 5 = 0 THEN 'no JSON' WHEN event_id % 3 = 0 THEN 'value of another type' ELSE 'read' END AS reason,
  count(*) AS records FROM events GROUP BY 1""",
    "scan_csv_dir": f"WITH {SPLIT} SELECT id, input_text, target_text, category, intent FROM split",
    "prepared_roundtrip": encoded_sql("split", carry="split"),
    "numbered_questions": _numbered_sql(),
    "source_or_default": f"""WITH {CLEAN}
SELECT CAST(row_number() OVER (ORDER BY {h('id')}, id) AS INTEGER) AS pos, instruction AS question
FROM (SELECT * FROM clean ORDER BY {h('id')}, id LIMIT 10)""",
    "response_log_roundtrip": _response_log_sql(),
    "metadata_json": ORACLES["split_metadata"],
    "profile_report_text": ("SELECT section || ': ' || name || ': ' || value AS value FROM ("
                            + ORACLES["profile_report"] + ")"),
    "validation_battery": _battery_sql(),
    "answer_stream": answers_sql(PROBE_LEXICON, BANK),
    "published_validation": """SELECT CASE event_type WHEN 'click' THEN 'template' ELSE 'model' END AS run, 'event ' || event_id AS query, props AS response,
  round(value, 6) AS response_time FROM events WHERE event_type IN ('click', 'view')""",
    "published_evaluation": """SELECT 'template' AS run, 'event ' || event_id AS query, props AS response, round(value, 6) AS response_time FROM events
UNION ALL SELECT 'model', 'event ' || event_id, upper(props), round(value * 2, 6) FROM events""",
    "published_inference": "SELECT 'model' AS run, 'event ' || event_id AS query, props AS response, round(value, 6) AS response_time FROM events",
    "answer_saved_bank": answers_sql(PROBE_LEXICON, BANK),
    "train_without_sample": f"WITH {SPLIT} SELECT id, intent FROM train",
    "numbered_sample": f"""WITH {CLEAN}, s AS (SELECT instruction, row_number() OVER (ORDER BY {h('id')}, id) AS pos FROM clean),
t AS (SELECT pos || '. ' || instruction AS value FROM s WHERE pos <= 10),
x AS (SELECT value, regexp_replace(value, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g') AS v FROM t)
SELECT value, substr(v, strpos(v, '. ') + 2) AS question FROM x""",
    "answer_stream_once": answers_sql(PROBE_LEXICON, BANK),
    "chat_history_stream": history_sql(PROBE_LEXICON),
    "chat_history": history_sql(PROBE_LEXICON),
    "chat_history_events": history_sql(PROBE_LEXICON, "ev", EVENTS + ","),
    "chat_history_events_stream": history_sql(PROBE_LEXICON, "ev", EVENTS + ","),
    "guarded_answers": (f"WITH {BANK}, {EVENTS}, q AS (SELECT conv_id, turn, text AS query FROM ev WHERE role = 'user'),\n"
                        f"{answer_ctes(PROBE_LEXICON)}\n"
                        "SELECT conv_id, turn, query, intent, route, response, prompt FROM answered"),
    "generate_batch": (f"WITH {QUESTIONS} SELECT conv_id, turn, {lit(MODEL_PROMPT_PREFIX)} || query AS prompt, "
                       f"{lit(MODEL_PROMPT_PREFIX)} || query AS generated FROM q"),
    "generate_distinct": (f"WITH {QUESTIONS} SELECT conv_id, turn, {lit(MODEL_PROMPT_PREFIX)} || query AS prompt, "
                          f"{lit(MODEL_PROMPT_PREFIX)} || query AS generated FROM q"),
    "map_batches": f"WITH {QUESTIONS} SELECT conv_id, turn, length(query) AS characters FROM q",
    "load_bank": f"""WITH {BANK}
SELECT 'present' AS source, intent, CAST(len(templates) AS BIGINT) AS n_templates, array_to_string(templates, ' || ') AS templates_text
FROM bank UNION ALL SELECT 'unreadable', 'general', {len(DEFAULT_BANK_TEMPLATES)}, {lit(" || ".join(DEFAULT_BANK_TEMPLATES))}""",
    "source_or_default_empty": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {lit(x)})" for i, x in enumerate(DEFAULT_QUESTIONS, 1)) + ") AS t(pos, question)",
    "prepare_labelled": _labelled_sql(),
    "train_or_sample": ORACLES["sample_train_rows"],
    "distinct_counts_hashed": ORACLES["distinct_counts"],
    "bank_json_roundtrip": ORACLES["template_bank"],
    "dedup_pairs_hash_first": ORACLES["dedup_pairs"],
    "label_vocabulary_or_default": ORACLES["label_vocabulary"],
    "top_values_hashed": ORACLES["top_values"],
    "encode_pairs_lookup": ORACLES["encode_pairs"],
    "metric_callback": """SELECT round(avg(CASE WHEN list_position(embedding, list_max(embedding)) - 1 <> label
                          THEN 1.0 ELSE 0.0 END), 6) AS error_rate, count(*) AS rows FROM embeddings""",
    "batch_metric": """SELECT CAST(sum(CASE WHEN list_position(embedding, list_max(embedding)) - 1 = label THEN 1 ELSE 0 END) AS BIGINT) AS hits,
                       count(*) AS rows FROM embeddings""",
    "response_info_stream": ORACLES["response_info"],
    "response_info_upsert": ORACLES["response_info"],
})


def _classifier_ctes() -> str:
    """Multinomial naive Bayes by counting: ``lp`` has ln P(class, tokens) of each validation row,
    class and smoothing; tokens that no fitted row has are left out."""
    return f"""WITH l AS (SELECT d.doc_id AS idx, d.text AS sentence, lb.quality AS label
           FROM documents d JOIN labels lb ON lb.doc_id = d.doc_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY {h('idx')}, idx) AS r, count(*) OVER () AS n FROM l),
sp AS (SELECT idx, sentence, label,
    CASE WHEN r <= ceil(n * 0.1::DOUBLE) THEN 'test'
         WHEN r <= ceil(n * 0.1::DOUBLE)
                   + ceil((0.1::DOUBLE / (1 - 0.1::DOUBLE)) * (n - ceil(n * 0.1::DOUBLE))) THEN 'val'
         ELSE 'train' END AS split FROM ranked),
tr AS (SELECT * FROM sp WHERE split = 'train' ORDER BY {h('idx')}, idx LIMIT {CLASSIFIER_TRAIN_ROWS}),
va AS (SELECT * FROM sp WHERE split = 'val'),
lam AS (SELECT 1 AS setting, 1.0::DOUBLE AS s UNION ALL SELECT 2, 0.1::DOUBLE),
tt AS (SELECT label AS cls, unnest({TOKENS.format(x='sentence')}) AS token FROM tr),
cnt AS (SELECT cls, token, count(*) AS n FROM tt GROUP BY ALL),
words AS (SELECT DISTINCT token FROM cnt),
tot AS (SELECT cls, sum(n) AS total FROM cnt GROUP BY cls),
cls AS (SELECT label AS cls, count(*) AS n FROM tr GROUP BY label),
vt AS (SELECT idx, unnest({TOKENS.format(x='sentence')}) AS token FROM va),
seen AS (SELECT idx, token, count(*) AS c FROM vt WHERE token IN (SELECT token FROM words) GROUP BY ALL),
body AS (SELECT seen.idx, cls.cls, lam.setting,
    sum(seen.c * (ln(coalesce(cnt.n, 0) + lam.s) - ln(tot.total + (SELECT count(*) FROM words) * lam.s))) AS b
  FROM seen CROSS JOIN cls CROSS JOIN lam JOIN tot ON tot.cls = cls.cls
  LEFT JOIN cnt ON cnt.cls = cls.cls AND cnt.token = seen.token GROUP BY ALL),
lp AS (SELECT va.idx, va.label, cls.cls, lam.setting, lam.s, coalesce(body.b, 0)
    + ln(cls.n + lam.s) - ln((SELECT count(*) FROM tr) + (SELECT count(*) FROM cls) * lam.s) AS lp
  FROM va CROSS JOIN cls CROSS JOIN lam
  LEFT JOIN body ON body.idx = va.idx AND body.cls = cls.cls AND body.setting = lam.setting),
pr AS (SELECT idx, label, setting, any_value(s) AS s, CAST(arg_max(cls, lp - cls * 1e-12) AS INTEGER) AS prediction,
    max(CASE WHEN cls = label THEN lp END) AS own, max(lp) AS top FROM lp GROUP BY idx, label, setting),
ev AS (SELECT pr.*, greatest(exp(own - top) / (SELECT sum(exp(q.lp - pr.top)) FROM lp q WHERE q.idx = pr.idx AND q.setting = pr.setting), 1e-15) AS p
  FROM pr)"""


ORACLES.update({
    "train_text_classifier": _classifier_ctes() + " SELECT idx, label, prediction FROM pr WHERE setting = 1",
    "save_model": _classifier_ctes() + " SELECT idx, label, prediction FROM pr WHERE setting = 1",
    "evaluate_classifier": _classifier_ctes() + """ SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg(-ln(p)), 6) AS log_loss, count(*) AS rows FROM ev WHERE setting = 1""",
    "select_best_by_accuracy": _classifier_ctes() + """,
acc AS (SELECT CAST(setting AS INTEGER) AS setting, any_value(s) AS smoothing, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS a
  FROM pr GROUP BY setting)
SELECT setting, round(smoothing, 6) AS smoothing, round(a, 6) AS accuracy,
  setting = (SELECT setting FROM acc ORDER BY a DESC, setting LIMIT 1) AS chosen FROM acc""",
})

ORACLES.update({
    "profile_state_lengths": ORACLES["length_stats"],
    "profile_state_histogram": ORACLES["length_histogram"],
    "profile_state_counts": f"""WITH {VALUES}
SELECT field, count(*) AS rows, count(value) AS non_null, count(DISTINCT value) AS distinct, true AS estimate_holds
FROM vals GROUP BY field""",
    "top_tokens": f"""WITH {CORPUS},
toks AS (SELECT unnest({TOKENS.format(x='response')}) AS token FROM corpus)
SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 1000""",
    "build_vocabulary_heavy": ORACLES["build_vocabulary"],
    "prepared_bucketed": ORACLES["prepared_roundtrip"],
    "dedup_against_index": f"""WITH {SPLIT}
SELECT id, instruction, response, category, intent FROM corpus
WHERE instruction IS NOT NULL AND response IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM train t WHERE t.input_text = corpus.instruction AND t.target_text = corpus.response)""",
    "chat_history_bucketed": ORACLES["chat_history"],
})
