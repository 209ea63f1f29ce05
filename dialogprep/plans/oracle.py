r"""The registered queries once more, as SQL for DuckDB.

Written from the definitions, not from the Spark plans: four separate regex
steps instead of the fused one, global windows instead of buckets, self-joins
instead of offsets.
"""

from __future__ import annotations

from dialogprep.config import ASSISTANT_PHRASES, EVAL_PROMPTS, TURN_CLOSE, TURN_OPEN

# Python's \s spelled out in ASCII, for RE2.
WS = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
UNIT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


OPEN, CLOSE = text(TURN_OPEN), text(TURN_CLOSE)


def clean(x: str) -> str:
    x = f"regexp_replace({x}, '{WS}+([.,!?;:])', '\\1', 'g')"
    x = f"regexp_replace({x}, '{WS}+([’''])' || '{WS}*', '\\1', 'g')"
    x = f"translate({x}, '’“”', '''\"\"')"
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


# --- Common table expressions ---------------------------------------------

CHAT_RAW = """
raw AS (
  SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i
  FROM conversations WHERE role <> 'system'
)"""

DOC_RAW = """
raw AS (
  SELECT doc_id AS conv_id, unnest(lines) AS text, unnest(range(len(lines))) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
)"""

TURNS = f"""
turns AS (SELECT conv_id, i, {clean("text")} AS content FROM raw)"""


def kept(lo: int = 2, hi: int = 500) -> str:
    return f"""
checked AS (
  SELECT *, bool_and(length(content) BETWEEN {lo} AND {hi})
    OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS good
  FROM turns
),
prefix AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS k FROM checked WHERE good),
msgs AS (
  SELECT conv_id, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'model' END AS role, content
  FROM prefix WHERE k - k % 2 >= 2 AND i < k - k % 2
)"""


CHAT = f"{CHAT_RAW}, {TURNS}, {kept()}"
DOCS = f"{DOC_RAW}, {TURNS}, {kept()}"

SEGMENTS = f"""
seg AS (SELECT *, {OPEN} || role || chr(10) || content || {CLOSE} || chr(10) AS seg FROM msgs)"""

TEXTS = f"""{SEGMENTS},
texts AS (SELECT conv_id, '<bos>' || string_agg(seg, '' ORDER BY i) AS text FROM seg GROUP BY conv_id)"""

SPANS = f"""{SEGMENTS},
placed AS (
  SELECT *, 5 + coalesce(sum(length(seg)) OVER
    (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM seg
),
spans AS (
  SELECT conv_id, i, content,
    CAST(row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS BIGINT) AS reply,
    CAST(base + length({OPEN} || role || chr(10)) AS BIGINT) AS "start",
    CAST(base + length(seg) - 1 AS BIGINT) AS "end"
  FROM placed WHERE role = 'model'
)"""

PIECES = """
pieces AS (
  SELECT conv_id, piece, k, CASE piece WHEN '<bos>' THEN 2 ELSE unicode(piece) END AS id
  FROM (
    SELECT conv_id, unnest(p) AS piece, unnest(range(len(p))) AS k
    FROM (
      SELECT conv_id, regexp_extract_all('<bos>' || string_agg(seg, '' ORDER BY i), '(?s).{1,5}') AS p
      FROM seg GROUP BY conv_id
    )
  )
)"""

ORDERED = """
heads AS (SELECT conv_id, count(*) AS n_messages FROM msgs GROUP BY conv_id),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || conv_id), conv_id) - 1 AS pos, count(*) OVER () AS n
  FROM heads
),
parted AS (
  SELECT conv_id, n_messages, pos,
    CASE WHEN pos < greatest(1, n // 20) THEN 'val' ELSE 'train' END AS split
  FROM ordered
)"""

LENGTHS = f"""
lengths AS (
  SELECT conv_id, CAST(1 + sum(5 + len(regexp_extract_all(content, '{UNIT}'))) AS BIGINT) AS n_units
  FROM msgs GROUP BY conv_id
)"""

TRAIN_LENGTHS = f"""{ORDERED}, {LENGTHS},
train_order AS (
  SELECT conv_id, n_units, row_number() OVER (ORDER BY md5('42:' || conv_id), conv_id) - 1 AS pos
  FROM lengths JOIN parted USING (conv_id) WHERE split = 'train'
)"""


def reply_of(raw: str) -> str:
    cut = f"split_part(split_part({raw}, '<end_of_turn>', 1), '<eos>', 1)"
    for token in ("<bos>", "<pad>", "<start_of_turn>"):
        cut = f"replace({cut}, '{token}', '')"
    return f"regexp_replace({cut}, '^{WS}+|{WS}+$', '', 'g')"


REPLIES = f"""
raws AS (
  SELECT 'stopped' AS run, conv_id, i,
    ' ' || content || '<end_of_turn>' || chr(10) || '<start_of_turn>user' || chr(10) || content AS raw
  FROM msgs WHERE role = 'model'
  UNION ALL
  SELECT 'rambling', conv_id, i, '<bos>' || content || ' ' || content || chr(10) FROM msgs WHERE role = 'model'
  UNION ALL
  SELECT 'assistant', conv_id, i, 'as an AI, ' || content || '<eos>' || content
  FROM msgs WHERE role = 'model' AND length(content) >= 100
),
replies AS (SELECT run, conv_id, i, raw, {reply_of("raw")} AS reply FROM raws)"""

LOSSES = """
losses AS (
  SELECT event_type AS run, CAST(day(ts) AS BIGINT) AS run_no, event_id % 50 + 2 AS n, value / 100 AS loss
  FROM events
)"""

TRAINING_LOG = """
log AS (
  SELECT user_id AS run, event_id AS step, value AS eval_loss,
    event_type IN ('view', 'click', 'purchase') AS saved
  FROM events
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_loss, step) AS by_loss,
    row_number() OVER (PARTITION BY run ORDER BY step DESC) AS by_age
  FROM log WHERE saved
)"""

PAIRS = f"""{ORDERED},
words AS (
  SELECT split, conv_id, i, role, unnest(ws) AS w, unnest(range(len(ws))) AS n_th
  FROM (SELECT conv_id, i, role, string_split(content, ' ') || ['</s>'] AS ws FROM msgs) JOIN parted USING (conv_id)
),
pairs AS (
  SELECT split, conv_id, role, w, coalesce(lag(w) OVER (PARTITION BY conv_id, i ORDER BY n_th), '<s>') AS prev FROM words
),
uni AS (SELECT w, count(*) AS c FROM pairs WHERE split = 'train' GROUP BY w),
bi AS (SELECT prev, w, count(*) AS c FROM pairs WHERE split = 'train' GROUP BY prev, w),
ctx AS (SELECT prev, count(*) AS c FROM pairs WHERE split = 'train' GROUP BY prev),
size AS (SELECT sum(c) AS n, count(*) + 1 AS v FROM uni),
uni_loss AS (
  SELECT conv_id, role, -ln((coalesce(uni.c, 0) + 1) / (size.n + size.v)) AS loss
  FROM pairs LEFT JOIN uni USING (w), size WHERE split = 'val'
),
bi_loss AS (
  SELECT conv_id, -ln((coalesce(bi.c, 0) + 1) / (coalesce(ctx.c, 0) + size.v)) AS loss
  FROM pairs LEFT JOIN bi USING (prev, w) LEFT JOIN ctx USING (prev), size WHERE split = 'val'
)"""


def ngram(table: str, run: str) -> str:
    return f"""WITH {DOCS}, {PAIRS}
SELECT '{run}' AS run, count(*) AS n_tokens, round(exp(avg(loss)), 4) AS perplexity FROM {table}"""


def chat_log(exits: bool) -> str:
    leave = "WHEN 'signup' THEN '/exit' " if exits else ""
    return f"""
lines AS (
  SELECT user_id AS session, event_id AS seq,
    CASE event_type WHEN 'purchase' THEN 'model' ELSE 'user' END AS role,
    CASE event_type WHEN 'error' THEN '/reset' {leave}ELSE event_type END AS line
  FROM events
),
open_lines AS (
  SELECT l.* FROM lines l
  LEFT JOIN (SELECT session, min(seq) AS gone FROM lines WHERE line = '/exit' GROUP BY session) x USING (session)
  WHERE gone IS NULL OR seq < gone
),
numbered AS (
  SELECT *, CAST(count(*) FILTER (line = '/reset') OVER
    (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
  FROM open_lines
),
folded AS (
  SELECT session, segment, row_number() OVER (PARTITION BY session, segment ORDER BY seq) - 1 AS pos, seq, role, line
  FROM numbered WHERE line <> '/reset'
)"""


def chat_history_idle(idle_seconds: int) -> str:
    """A pause longer than that starts a new page; pages hold 1,024 messages."""
    return f"""WITH {chat_log(False)},
timed AS (
  SELECT l.session, l.seq, l.line, coalesce(epoch_us(e.ts) > max(epoch_us(e.ts)) OVER
    (PARTITION BY l.session ORDER BY l.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {idle_seconds * 1_000_000}, false) AS pause
  FROM lines l JOIN events e ON e.event_id = l.seq
),
stretches AS (
  SELECT session, seq, count(*) FILTER (pause) OVER (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS stretch FROM timed
),
placed AS (
  SELECT f.*, row_number() OVER (PARTITION BY session, segment, stretch ORDER BY seq) - 1 AS since
  FROM folded f JOIN stretches USING (session, seq)
),
paged AS (SELECT * EXCLUDE (since), pos - since % 1024 AS history_from FROM placed)
SELECT *, array_to_string(list(role || ':' || line) OVER
  (PARTITION BY session, segment, history_from ORDER BY seq ROWS UNBOUNDED PRECEDING), '|') AS history
FROM paged"""


def chat_history(exits: bool) -> str:
    return f"""WITH {chat_log(exits)}
SELECT *, array_to_string(list(role || ':' || line) OVER
  (PARTITION BY session, segment ORDER BY seq ROWS UNBOUNDED PRECEDING), '|') AS history
FROM folded"""


def funnel(source: str) -> str:
    return f"""WITH {source}, {TURNS},
bad AS (
  SELECT conv_id, min(i) AS cut, arg_min(length(content), i) AS size
  FROM turns WHERE NOT length(content) BETWEEN 2 AND 500 GROUP BY conv_id
),
per AS (
  SELECT conv_id, n, cut, size, coalesce(cut, n) AS k
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id) LEFT JOIN bad USING (conv_id)
),
rows_ AS (
  SELECT 'kept' AS reason, k - k % 2 AS t FROM per WHERE k >= 2
  UNION ALL SELECT 'too_short', 1 FROM per WHERE size < 2
  UNION ALL SELECT 'too_long', 1 FROM per WHERE size > 500
  UNION ALL SELECT 'after_cut', n - cut - 1 FROM per WHERE n - cut - 1 > 0
  UNION ALL SELECT 'under_min_turns', k FROM per WHERE k < 2
  UNION ALL SELECT 'trailing_user', 1 FROM per WHERE k >= 2 AND k % 2 = 1
)
SELECT r.reason, count(t) AS conversations, CAST(coalesce(sum(t), 0) AS BIGINT) AS turns
FROM (VALUES ('kept'), ('too_short'), ('too_long'), ('after_cut'), ('under_min_turns'), ('trailing_user')) r(reason)
LEFT JOIN rows_ USING (reason) GROUP BY r.reason"""


def sweep(source: str) -> str:
    return f"""WITH {source}, {TURNS},
bands AS (SELECT lo, hi FROM (VALUES (1), (2), (20)) a(lo), (VALUES (200), (500), (2000)) b(hi)),
checked AS (
  SELECT lo, hi, conv_id, bool_and(length(content) BETWEEN lo AND hi)
    OVER (PARTITION BY lo, hi, conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS good
  FROM turns, bands
),
per AS (SELECT lo, hi, conv_id, count(*) FILTER (good) AS k FROM checked GROUP BY ALL)
SELECT CAST(lo AS BIGINT) AS min_chars, CAST(hi AS BIGINT) AS max_chars,
  count(*) FILTER (k >= 2) AS conversations,
  CAST(coalesce(sum(k - k % 2) FILTER (k >= 2), 0) AS BIGINT) AS messages
FROM per GROUP BY lo, hi"""


def roles(source: str, known: str, replying: str) -> str:
    return f"""WITH seq AS (
  SELECT key, pos, role, lag(role) OVER w AS prev, lead(pos) OVER w IS NULL AS is_last
  FROM ({source}) WINDOW w AS (PARTITION BY key ORDER BY pos)
),
found AS (
  SELECT key, 'unknown_role' AS violation FROM seq WHERE role NOT IN {known}
  UNION ALL SELECT key, 'broken_alternation' FROM seq WHERE role = prev
  UNION ALL SELECT key, 'not_ending_on_reply' FROM seq WHERE is_last AND role NOT IN {replying}
)
SELECT v.violation, count(key) AS rows, count(DISTINCT key) AS conversations
FROM (VALUES ('unknown_role'), ('broken_alternation'), ('not_ending_on_reply')) v(violation)
LEFT JOIN found USING (violation) GROUP BY v.violation"""


SPACED = (
    "translate(replace(regexp_replace(text, '([.,!?;:])', ' \\1', 'g'), 'and', 'I ’ m “ s ”'), chr(10), '　')"
)

PROMPTS = f"(VALUES {', '.join(f'({i}, {text(p)})' for i, p in enumerate(EVAL_PROMPTS))}) p(prompt_id, prompt)"

MESSAGES = "SELECT conv_id, i, role, content FROM msgs"
def band_grid(source: str) -> str:
    """Steps of running extremes, two turns at a time, against 10,000 bands."""
    return f"""WITH {source}, {TURNS},
run AS (
  SELECT i, min(coalesce(length(content), -1)) OVER w AS low, max(coalesce(length(content), 2147483647)) OVER w AS high
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
),
steps AS (
  SELECT low, high, count(*) FILTER (i = 1) AS conversations, 2 * count(*) AS messages
  FROM run WHERE i % 2 = 1 GROUP BY low, high
),
bands AS (SELECT lo, 25 * hi AS hi FROM range(100) a(lo), range(1, 101) b(hi))
SELECT CAST(lo AS BIGINT) AS min_chars, CAST(hi AS BIGINT) AS max_chars,
  CAST(coalesce(sum(conversations), 0) AS BIGINT) AS conversations, CAST(coalesce(sum(messages), 0) AS BIGINT) AS messages
FROM bands LEFT JOIN steps ON low >= lo AND high <= hi GROUP BY lo, hi"""


# Plain quotes, A-Z in lower case.
FOLDED = """translate({0}, '’“”ABCDEFGHIJKLMNOPQRSTUVWXYZ', '''\"\"abcdefghijklmnopqrstuvwxyz')"""

MASKED = """masked AS (
  SELECT conv_id, k, id, EXISTS (
    SELECT 1 FROM spans s WHERE s.conv_id = p.conv_id AND s."start" < 5 * k + length(piece) AND 5 * k < s."end"
  ) AS m FROM pieces p
)"""

HISTORY = chat_history(exits=False)
HISTORY_IDLE = chat_history_idle(86400)
STREAMED = f"""WITH {DOCS}, {TEXTS}
SELECT conv_id, 0 AS part, text,
  CASE WHEN CAST('0x' || substr(md5('42:' || conv_id), 1, 15) AS BIGINT) < {int(0.05 * (1 << 60))}
    THEN 'val' ELSE 'train' END AS split
FROM texts"""

ORACLES: dict[str, str] = {
    "clean_utterance_turns": f"SELECT conv_id, turn, {clean('text')} AS content FROM conversations",
    "clean_utterance_spaced": f"SELECT conv_id, turn, {clean(SPACED)} AS content FROM conversations",
    "turns_to_dialogs": f"""WITH {CHAT_RAW}
SELECT conv_id, count(*) AS n_turns, string_agg(text, '|' ORDER BY i) AS joined FROM raw GROUP BY conv_id""",
    "prepare_messages": f"WITH {CHAT} {MESSAGES}",
    "prepare_messages_docs": f"WITH {DOCS} {MESSAGES}",
    "filter_funnel": funnel(CHAT_RAW),
    "filter_funnel_docs": funnel(DOC_RAW),
    "length_band_sweep": sweep(CHAT_RAW),
    "length_band_sweep_docs": sweep(DOC_RAW),
    "holdout_split": f"WITH {DOCS}, {ORDERED} SELECT conv_id, split FROM parted",
    "seeded_shuffle": f"WITH {DOCS}, {ORDERED} SELECT conv_id, pos FROM parted",
    "shuffle_head": f"WITH {DOCS}, {ORDERED} SELECT conv_id, n_messages FROM parted WHERE pos < 64",
    "first_row": f"""WITH {CHAT}, {TEXTS}
SELECT conv_id, text FROM texts ORDER BY md5('42:' || conv_id), conv_id LIMIT 1""",
    "prepare_counts": f"""WITH {DOCS}, {ORDERED}
SELECT 'loaded' AS stage, count(*) AS conversations FROM documents
UNION ALL SELECT 'kept', count(*) FROM parted
UNION ALL SELECT 'train', count(*) FROM parted WHERE split = 'train'
UNION ALL SELECT 'val', count(*) FROM parted WHERE split = 'val'""",
    "leak_audit": f"""WITH {DOCS}, {ORDERED},
hashes AS (
  SELECT conv_id, md5(CAST(to_json(list({{'role': role, 'content': content}} ORDER BY i)) AS VARCHAR)) AS h
  FROM msgs GROUP BY conv_id
),
keyed AS (
  SELECT split, 'id' AS kind, CAST(conv_id AS VARCHAR) AS key FROM parted
  UNION ALL SELECT split, 'content', h FROM parted JOIN hashes USING (conv_id)
)
SELECT t.kind, t.key, t.train_rows, v.val_rows
FROM (SELECT kind, key, count(*) AS train_rows FROM keyed WHERE split = 'train' GROUP BY ALL) t
JOIN (SELECT kind, key, count(*) AS val_rows FROM keyed WHERE split = 'val' GROUP BY ALL) v USING (kind, key)""",
    "train_minus_val": f"WITH {DOCS}, {ORDERED} SELECT conv_id, n_messages FROM parted WHERE split = 'train'",
    "render_chat": f"WITH {CHAT}, {TEXTS} SELECT conv_id, 0 AS part, text FROM texts",
    "render_prompt": f"""WITH {CHAT}, {TEXTS}
SELECT conv_id, 0 AS part, text || {OPEN} || 'model' || chr(10) AS text FROM texts""",
    "render_chat_docs": f"WITH {DOCS}, {TEXTS} SELECT conv_id, 0 AS part, text FROM texts",
    "bos_check": f"WITH {CHAT}, {TEXTS} SELECT conv_id, length(text) <= 1000 AS one_bos FROM texts",
    "reply_spans": f'WITH {DOCS}, {SPANS} SELECT conv_id, 0 AS part, reply, "start", "end" FROM spans',
    "labeled_text": f"""WITH {CHAT}, {SPANS}
SELECT conv_id, 0 AS part, reply, content || {CLOSE} AS labeled FROM spans""",
    "label_fraction": f"""WITH {CHAT}, {SPANS},
total AS (SELECT conv_id, 5 + sum(length(seg)) AS t FROM seg GROUP BY conv_id),
part_ AS (SELECT conv_id, sum("end" - "start") AS l FROM spans GROUP BY conv_id)
SELECT conv_id, 0 AS part, CAST(l AS BIGINT) AS labeled_chars, CAST(t AS BIGINT) AS total_chars,
  round(CAST(l AS DOUBLE) / CAST(t AS DOUBLE), 6) AS fraction
FROM total JOIN part_ USING (conv_id)""",
    "label_total": f"""WITH {DOCS}, {SPANS},
t AS (SELECT sum(length(seg)) + 5 * count(DISTINCT conv_id) AS t FROM seg),
l AS (SELECT sum("end" - "start") AS l FROM spans)
SELECT CAST(l AS BIGINT) AS labeled_chars, CAST(t AS BIGINT) AS total_chars,
  round(CAST(l AS DOUBLE) / CAST(t AS DOUBLE), 6) AS fraction
FROM t, l""",
    "label_total_full": f"""WITH {DOCS}, {SEGMENTS},
t AS (SELECT CAST(sum(length(seg)) + 5 * count(DISTINCT conv_id) AS BIGINT) AS t FROM seg)
SELECT t AS labeled_chars, t AS total_chars, CAST(1 AS DOUBLE) AS fraction FROM t""",
    "token_mask": f"""WITH {DOCS}, {SPANS}, {PIECES},
masked AS (
  SELECT conv_id, k, id, EXISTS (
    SELECT 1 FROM spans s WHERE s.conv_id = p.conv_id AND s."start" < 5 * k + length(piece) AND 5 * k < s."end"
  ) AS m FROM pieces p
)
SELECT conv_id, 0 AS part, count(*) AS n_tokens, count(*) FILTER (m) AS labeled_tokens,
  string_agg(CASE WHEN m THEN '1' ELSE '0' END, '' ORDER BY k) AS mask,
  string_agg(id, ',' ORDER BY k) FILTER (m) AS labeled_ids
FROM masked GROUP BY conv_id""",
    "token_bos_check": f"""WITH {CHAT}, {SEGMENTS}, {PIECES}
SELECT conv_id, sum(length(piece)) <= 1000 AS one_bos FROM pieces GROUP BY conv_id""",
    "context_reply_pairs": f"""WITH {CHAT}, {SPANS}
SELECT x.conv_id, 0 AS part, x.reply,
  '<bos>' || string_agg(y.seg, '' ORDER BY y.i) || {OPEN} || 'model' || chr(10) AS prompt,
  x.content || {CLOSE} AS completion
FROM spans x JOIN seg y ON y.conv_id = x.conv_id AND y.i < x.i
GROUP BY x.conv_id, x.reply, x.content""",
    "context_reply_pairs_window": f"""WITH {CHAT}, {SPANS}
SELECT x.conv_id, 0 AS part, x.reply,
  '<bos>' || string_agg(y.seg, '' ORDER BY y.i) || {OPEN} || 'model' || chr(10) AS prompt,
  x.content || {CLOSE} AS completion
FROM spans x JOIN seg y ON y.conv_id = x.conv_id AND y.i < x.i AND y.i >= x.i - 4
GROUP BY x.conv_id, x.reply, x.content""",
    "token_label_fraction": f"""WITH {DOCS}, {SPANS}, {PIECES}, {MASKED}
SELECT conv_id, 0 AS part, count(*) FILTER (m) AS labeled_tokens, count(*) AS total_tokens,
  round(CAST(count(*) FILTER (m) AS DOUBLE) / count(*), 6) AS fraction
FROM masked GROUP BY conv_id""",
    "token_label_total": f"""WITH {DOCS}, {SPANS}, {PIECES}, {MASKED}
SELECT count(*) FILTER (m) AS labeled_tokens, count(*) AS total_tokens,
  round(CAST(count(*) FILTER (m) AS DOUBLE) / count(*), 6) AS fraction
FROM masked""",
    "length_band_grid": band_grid(CHAT_RAW),
    "length_band_grid_docs": band_grid(DOC_RAW),
    "length_sketches": f"""WITH {DOCS}, {LENGTHS},
whole AS (SELECT count(*) AS conversations, CAST(sum(n_units) AS BIGINT) AS units, max(n_units) AS longest FROM lengths)
SELECT whole.*, CAST(q AS BIGINT) AS quantile, true AS "within" FROM whole, (VALUES (50), (90), (99)) v(q)""",
    "pack_best_fit": f"""WITH RECURSIVE {DOCS}, {TRAIN_LENGTHS},
ranked AS (
  SELECT conv_id, n_units, pos // 1024 AS shard, row_number() OVER (PARTITION BY pos // 1024 ORDER BY n_units DESC, pos) AS k
  FROM train_order
),
fill AS (
  SELECT shard, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS rooms, CAST(NULL AS BIGINT) AS conv_id,
    CAST(NULL AS BIGINT) AS n_units, CAST(NULL AS BIGINT) AS bin
  FROM ranked GROUP BY shard
  UNION ALL
  SELECT shard, k,
    CASE WHEN spot IS NULL THEN list_append(rooms, greatest(1024 - n, 0))
      ELSE list_transform(rooms, lambda r, i: CASE WHEN i = spot THEN r - n ELSE r END) END,
    conv_id, n, CAST(coalesce(spot - 1, len(rooms)) AS BIGINT)
  FROM (
    SELECT f.shard, o.k, f.rooms, o.conv_id, o.n_units AS n,
      list_position(f.rooms, list_min(list_filter(f.rooms, lambda r: r >= o.n_units))) AS spot
    FROM fill f JOIN ranked o ON o.shard = f.shard AND o.k = f.k + 1
  )
)
SELECT conv_id, n_units, shard, bin FROM fill WHERE k > 0""",
    "train_plan": f"""WITH {DOCS}, {ORDERED},
e AS (SELECT count(*) AS examples FROM parted WHERE split = 'train'),
s AS (SELECT examples, CAST(ceil(examples / 32) AS BIGINT) AS steps_per_epoch FROM e)
SELECT examples, steps_per_epoch, CAST(steps_per_epoch * 3 AS BIGINT) AS total_steps,
  CAST(greatest(1, round_even(CAST(0.03 AS DOUBLE) * steps_per_epoch * 3, 0)) AS BIGINT) AS warmup_steps
FROM s""",
    "length_profile": f"""WITH {DOCS}, {LENGTHS}
SELECT count(*) AS conversations, CAST(sum(n_units) AS BIGINT) AS units,
  round(quantile_cont(CAST(n_units AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST(n_units AS DOUBLE), 0.9), 6) AS p90,
  round(quantile_cont(CAST(n_units AS DOUBLE), 0.99), 6) AS p99,
  max(n_units) AS longest,
  count(*) FILTER (n_units > 512) AS over_512,
  CAST(sum(greatest(n_units - 512, 0)) AS BIGINT) AS lost_512,
  count(*) FILTER (n_units > 1024) AS over_1024,
  CAST(sum(greatest(n_units - 1024, 0)) AS BIGINT) AS lost_1024
FROM lengths""",
    "batch_plan": f"""WITH {DOCS}, {TRAIN_LENGTHS}
SELECT pos // 16 AS batch, count(*) AS n_rows, max(n_units) AS longest, CAST(sum(n_units) AS BIGINT) AS units,
  CAST(max(n_units) * count(*) - sum(n_units) AS BIGINT) AS padding
FROM train_order GROUP BY ALL""",
    "pack_sequences": f"""WITH RECURSIVE {DOCS}, {TRAIN_LENGTHS},
fill AS (
  SELECT conv_id, n_units, pos, CAST(0 AS BIGINT) AS bin, n_units AS used FROM train_order WHERE pos % 1024 = 0
  UNION ALL
  SELECT o.conv_id, o.n_units, o.pos,
    CASE WHEN f.used + o.n_units > 1024 THEN f.bin + 1 ELSE f.bin END,
    CASE WHEN f.used + o.n_units > 1024 THEN o.n_units ELSE f.used + o.n_units END
  FROM fill f JOIN train_order o ON o.pos = f.pos + 1 AND o.pos % 1024 <> 0
)
SELECT conv_id, n_units, pos // 1024 AS shard, bin FROM fill""",
    "perplexity": f"""WITH {LOSSES}
SELECT run, CAST(sum(n) AS BIGINT) AS n_tokens, round(exp(sum(loss * n) / sum(n)), 6) AS perplexity
FROM losses GROUP BY run""",
    "perplexity_shifted": f"""WITH {LOSSES}
SELECT run, CAST(sum(n) AS BIGINT) AS n_tokens,
  round(exp(sum(loss * (n - 1)) / sum(n - 1)), 6) AS perplexity
FROM losses GROUP BY run""",
    "run_trend": f"""WITH {LOSSES},
p AS (SELECT run_no, CAST(sum(n) AS BIGINT) AS n_tokens, exp(sum(loss * n) / sum(n)) AS p FROM losses GROUP BY run_no)
SELECT run_no, n_tokens, round(p, 6) AS perplexity, round(p - lag(p) OVER (ORDER BY run_no), 6) AS change FROM p""",
    "ngram_losses": f"""WITH {DOCS}, {PAIRS}
SELECT '1-gram' AS run, conv_id, count(*) AS n_tokens, round(avg(loss), 6) AS mean_loss
FROM uni_loss GROUP BY conv_id""",
    "ngram_losses_replies": f"""WITH {DOCS}, {PAIRS}
SELECT '1-gram' AS run, conv_id, count(*) AS n_tokens, round(avg(loss), 6) AS mean_loss
FROM uni_loss WHERE role = 'model' GROUP BY conv_id""",
    "ngram_perplexity": ngram("uni_loss", "1-gram"),
    "bigram_perplexity": ngram("bi_loss", "2-gram"),
    "best_checkpoint": f"WITH {TRAINING_LOG} SELECT run, step, eval_loss FROM ranked WHERE by_loss = 1",
    "checkpoint_retention": f"""WITH {TRAINING_LOG}
SELECT run, step, eval_loss, by_loss = 1 AS is_best FROM ranked WHERE by_age <= 2 OR by_loss = 1""",
    "eval_matrix": f"""SELECT run, CAST(prompt_id AS BIGINT) AS prompt_id, prompt,
  '<bos>' || {OPEN} || 'user' || chr(10) || prompt || {CLOSE} || chr(10) || {OPEN} || 'model' || chr(10) AS rendered
FROM (SELECT DISTINCT user_id AS run FROM events), {PROMPTS}""",
    "extract_reply": f"WITH {DOCS}, {REPLIES} SELECT run, conv_id, i, reply FROM replies",
    "side_by_side": f"""WITH {DOCS}, {REPLIES}
SELECT conv_id, i, a.reply AS reply_a, b.reply AS reply_b,
  CAST(a.reply IS NOT NULL AS BIGINT) AS n_a, CAST(b.reply IS NOT NULL AS BIGINT) AS n_b
FROM (SELECT * FROM replies WHERE run = 'stopped') a
FULL JOIN (SELECT * FROM replies WHERE run = 'assistant') b USING (conv_id, i)""",
    "stop_audit": f"""WITH {DOCS}, {REPLIES}
SELECT run, count(*) AS replies,
  count(*) FILTER (NOT contains(raw, '<end_of_turn>') AND NOT contains(raw, '<eos>')) AS no_stop,
  count(*) FILTER (len(regexp_extract_all(
    split_part(split_part(raw, '<end_of_turn>', 1), '<eos>', 1), '{UNIT}')) >= 60) AS at_cap
FROM replies GROUP BY run""",
    "repeated_ngrams": f"""WITH {DOCS}, {REPLIES},
grams AS (
  SELECT run, list_transform(range(1, greatest(len(ws) - 1, 1)),
    lambda j: ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2]) AS g
  FROM (SELECT run, list_filter(regexp_split_to_array(reply, '{WS}+'), lambda w: w <> '') AS ws FROM replies)
)
SELECT run, count(*) AS replies, CAST(sum(len(g)) AS BIGINT) AS ngrams,
  CAST(sum(len(g) - len(list_distinct(g))) AS BIGINT) AS repeated,
  count(*) FILTER (len(g) > len(list_distinct(g))) AS looping_replies,
  round(CAST(sum(len(g) - len(list_distinct(g))) AS DOUBLE) / CAST(sum(len(g)) AS DOUBLE), 6) AS rate
FROM grams GROUP BY run""",
    "assistant_voice": f"""WITH {DOCS}, {REPLIES},
flags AS (
  SELECT run, {" OR ".join(f"contains(lower(reply), {text(p.lower())})" for p in ASSISTANT_PHRASES)} AS f
  FROM replies
)
SELECT run, count(*) AS replies, count(*) FILTER (f) AS flagged,
  round(CAST(count(*) FILTER (f) AS DOUBLE) / count(*), 6) AS rate
FROM flags GROUP BY run""",
    "assistant_voice_table": f"""WITH {DOCS}, {REPLIES},
heads AS (
  SELECT array_to_string(regexp_split_to_array(trim(text, ' '), ' +')[1:3], ' ') AS phrase FROM benchmark
  UNION ALL SELECT array_to_string(regexp_split_to_array(trim(text, ' '), ' +')[1:3], ' ') FROM documents
  UNION ALL VALUES {", ".join(f"({text(p)})" for p in ASSISTANT_PHRASES)}
),
phrases AS (SELECT DISTINCT {FOLDED.format("phrase")} AS phrase FROM heads WHERE length(phrase) >= 8),
folded_replies AS (SELECT run, conv_id, i, {FOLDED.format("reply")} AS t FROM replies),
hits AS (SELECT run, conv_id, i, phrase FROM folded_replies JOIN phrases ON contains(t, phrase)),
per AS (SELECT run, count(DISTINCT (conv_id, i)) AS flagged, count(DISTINCT phrase) AS phrases FROM hits GROUP BY run)
SELECT r.run, r.replies, coalesce(flagged, 0) AS flagged, coalesce(phrases, 0) AS phrases,
  round(CAST(coalesce(flagged, 0) AS DOUBLE) / replies, 6) AS rate
FROM (SELECT run, count(*) AS replies FROM replies GROUP BY run) r LEFT JOIN per USING (run)""",
    "role_audit": roles(
        "SELECT conv_id AS key, turn AS pos, role FROM conversations",
        "('user', 'model', 'assistant')",
        "('model', 'assistant')",
    ),
    "role_audit_events": roles(
        "SELECT user_id AS key, event_id AS pos, event_type AS role FROM events",
        "('view', 'click', 'purchase', 'signup')",
        "('click', 'purchase')",
    ),
    "chat_fold": f"WITH {chat_log(exits=False)} SELECT * FROM folded",
    "chat_history": HISTORY,
    "chat_history_exit": chat_history(exits=True),
    "chat_history_stream_events": HISTORY,
    "chat_history_ordered_stream_events": HISTORY,
    "chat_history_idle_events": HISTORY_IDLE,
    "chat_history_expiring_stream_events": HISTORY_IDLE,
    "prepare_stream_docs": STREAMED,
    "prepare_stream_restarted_docs": STREAMED,
    "filter_funnel_observed": funnel(CHAT_RAW),
    "jsonl_roundtrip": f"WITH {CHAT} {MESSAGES}",
    "split_roundtrip": f"""WITH {DOCS}, {ORDERED}
SELECT CASE split WHEN 'val' THEN 'validation' ELSE split END AS split, conv_id, n_messages FROM parted""",
    "split_pruning": f"""WITH {DOCS}, {TEXTS}, {ORDERED}
SELECT conv_id, 0 AS part, text FROM texts JOIN parted USING (conv_id) WHERE split = 'val'""",
    "dialogs_roundtrip": f"WITH {CHAT} {MESSAGES}",
}
