"""DuckDB oracle SQL for the registered queries (run by the driver at sf0.01).

The text chain follows the reference job step by step (three regex
replacements, split on non-word characters, minimum length, stopword filter,
intersection with the raw keyword set), so it checks the fused tokenizer and
the keyword-side stopword pruning of the Spark plan rather than copying them.
One shared chain of CTEs; DuckDB evaluates only those a query uses.
"""

from __future__ import annotations

from surgewatch.config import DEFAULT_WEIGHTS
from surgewatch.functions.stopwords import ENGLISH_STOPWORDS
from surgewatch.functions.text import LINE_BREAK_RE, PY_SPACE_CLASS
from surgewatch.functions.timefmt import interval_seconds
from surgewatch.plans import catalog as Q
from surgewatch.sources.fixtures import DEFAULT_BUCKET, FIXTURE_WORDBAG

BUCKET = DEFAULT_BUCKET


def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


_STOP = "[" + ", ".join(_s(w) for w in ENGLISH_STOPWORDS) + "]"
_BAG = ", ".join(f"({_s(c)}, {_s(k)})" for c, k in FIXTURE_WORDBAG)
_W = [float(x) for x in DEFAULT_WEIGHTS]
_JSPACE = r"\t\n\x0B\f\r "   # Java's \s


def _score(g="short_term_growth", l="long_term_ratio", r="ratio_to_total", v="volatility",
           a="acceleration") -> str:
    return f"{_W[0]} * {g} + {_W[1]} * {l} + {_W[2]} * {r} + {_W[3]} * {v} + {_W[4]} * {a}"


def _truthy(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> 0)"


def _growth(cur: str, prev: str) -> str:
    d = f"(CASE WHEN {prev} > 0 THEN {prev} ELSE 1 END)"
    return f"(CAST({cur} - {d} AS DOUBLE) / {d})"


def _slots(step_us: int) -> str:
    return ",\n".join(
        f"    max(count_category) OVER (s RANGE BETWEEN {k * step_us} PRECEDING AND "
        f"{k * step_us} PRECEDING) AS slot_{k}" for k in range(1, 7))


def _chain_growths() -> str:
    chain = ["cur"] + [f"slot_{k}" for k in range(1, 7)]
    gs = []
    for k in range(6):
        a, b = chain[k], chain[k + 1]
        gs.append(f"CASE WHEN {_truthy(a)} AND {_truthy(b)} THEN {_growth(a, b)} END")
    return "list_value(" + ", ".join(gs) + ")"


_P6 = [f"(CASE WHEN slot_{k} > 0 THEN slot_{k} END)" for k in range(1, 7)]
_N3 = " + ".join(f"(CASE WHEN {p} IS NOT NULL THEN 1 ELSE 0 END)" for p in _P6[:3])
_S3 = " + ".join(f"coalesce({p}, 0)" for p in _P6[:3])
_N6 = " + ".join(f"(CASE WHEN {p} IS NOT NULL THEN 1 ELSE 0 END)" for p in _P6)
_S6 = " + ".join(f"coalesce({p}, 0)" for p in _P6)


def _items_cte(name: str, src_posts: str) -> str:
    """Alert items of a job run over the post set ``src_posts`` (a CTE name)."""
    return f"""
{name}_hits AS (SELECT h.* FROM hits h WHERE h.post_id IN (SELECT post_id FROM {src_posts})),
{name}_kw AS (SELECT collected_time, channel, query, category, keyword, count(*) AS count_keyword
              FROM {name}_hits WHERE category <> 'no' GROUP BY ALL),
{name}_cat AS (SELECT collected_time, channel, query, category, count(*) AS count_category
               FROM {name}_hits WHERE category <> 'no' GROUP BY ALL),
{name}_b AS (
  SELECT channel, query, category, collected_time AS cur_time, count_category AS cur_count,
    lag(collected_time) OVER s AS prev_time, lag(count_category) OVER s AS prev_count,
    avg(count_category) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS avg_long,
    stddev_samp(count_category) OVER (s ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS sd_vol,
    avg(count_category) OVER (s ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS avg_vol,
    sum(count_category) OVER (PARTITION BY channel, query, collected_time) AS total
  FROM {name}_cat WINDOW s AS (PARTITION BY channel, query, category ORDER BY collected_time)
),
{name}_g AS (
  SELECT *,
    CAST(cur_count - prev_count AS DOUBLE) / (CASE WHEN prev_count > 0 THEN prev_count ELSE 1 END)
      AS short_term_growth,
    cur_count / NULLIF(avg_long, 0) AS long_term_ratio, sd_vol / NULLIF(avg_vol, 0) AS volatility,
    CAST(cur_count AS DOUBLE) / NULLIF(total, 0) AS ratio_to_total
  FROM {name}_b
),
{name}_m AS (
  SELECT *, {_score(a="acc")} AS score FROM (
    SELECT *, short_term_growth - lag(short_term_growth) OVER
      (PARTITION BY channel, query, category ORDER BY cur_time) AS acc FROM {name}_g)
),
{name} AS (
  SELECT r.channel || '#' || r.query || '#' || r.category AS pk,
    strftime(r.cur_time, '%Y-%m-%dT%H:%M:%S') || '+00:00#' || c.keyword AS sk,
    r.channel, r.query, r.category, r.cur_time, r.prev_time,
    CAST(r.cur_count AS INTEGER) AS cur_count, CAST(r.prev_count AS INTEGER) AS prev_count,
    c.keyword, CAST(c.count_keyword AS INTEGER) AS count_keyword,
    {_dec('r.short_term_growth')} AS short_term_growth,
    {_dec('r.long_term_ratio')} AS long_term_ratio,
    {_dec('r.ratio_to_total')} AS ratio_to_total,
    {_dec('r.acc')} AS acceleration,
    {_dec('r.score')} AS score
  FROM {name}_m r JOIN {name}_kw c ON r.cur_time = c.collected_time AND r.channel = c.channel
    AND r.query = c.query AND r.category = c.category
  WHERE r.score > 2.0
),"""


def _dec(x: str) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(38,6)) AS DECIMAL(38,18))"


ITEMS = (
    "all_posts AS (SELECT post_id FROM posts),\n"
    f"stored_posts AS (SELECT post_id FROM posts WHERE uploaded_time < TIMESTAMP '{Q.STORED_BEFORE}'),"
    + _items_cte("items", "all_posts") + _items_cte("stored", "stored_posts") + """
new_items AS (
  SELECT i.* FROM items i WHERE NOT EXISTS
    (SELECT 1 FROM stored s WHERE s.pk = i.pk AND s.sk = i.sk)
),
groups AS (
  SELECT pk, channel, query, category, cur_time, prev_time,
    string_agg(' ' || keyword || ' (' || CAST(count_keyword AS VARCHAR) || '건)', ', '
               ORDER BY count_keyword DESC, keyword) AS keywords,
    count(*) AS n_keywords, max(short_term_growth) AS short_term_growth, max(score) AS score
  FROM new_items GROUP BY pk, channel, query, category, cur_time, prev_time
),
groups_all AS (
  SELECT pk, channel, query, category, cur_time, prev_time,
    string_agg(' ' || keyword || ' (' || CAST(count_keyword AS VARCHAR) || '건)', ', '
               ORDER BY count_keyword DESC, keyword) AS keywords,
    count(*) AS n_keywords, max(short_term_growth) AS short_term_growth, max(score) AS score
  FROM items GROUP BY pk, channel, query, category, cur_time, prev_time
),"""
)

_ISO = "strftime({x}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
MESSAGE = (
    "'[' || channel || '] ' || category || ' issue detected: monitoring needed' || chr(10) || "
    "'- query: ' || query || chr(10) || "
    f"'- collected: ' || {_ISO.format(x='prev_time')} || ' ~ ' || {_ISO.format(x='cur_time')}"
    " || chr(10) || "
    "'- surging category: ' || category || ' (+' || "
    "CAST(round(CAST(short_term_growth AS DOUBLE) * 100, 1) AS VARCHAR) || '%)' || chr(10) || "
    "'- top keywords:' || keywords"
)

_KEYS = "channel, query, category, cur_time"


def _r(cols: str) -> str:
    """Round the listed double columns to 6 places."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols.split(", "))


_SPOKEN = (f"(SELECT *, list_value({', '.join(map(_s, Q.SPOKEN))})[CAST(post_id % {len(Q.SPOKEN)} AS INTEGER) + 1] AS q"
           " FROM posts)")
_TOK_OUT = "array_to_string({a}, ' ') AS tokens, CAST(len({a}) AS BIGINT) AS n_tokens"
_MAP8 = "username, uploaded_time, collected_time, channel, query, text, category, keyword"
_ALERT_DOUBLES = "short_term_growth, long_term_ratio, ratio_to_total, acceleration, score"
_ALERT_OUT = ("channel, query, category, cur_time, prev_time, cur_count, prev_count, keyword, "
              "count_keyword, " + _r(_ALERT_DOUBLES))
_METRIC_DOUBLES = "short_term_growth, long_term_ratio, volatility, ratio_to_total, acceleration, score"
_METRICS_OUT = ("channel, query, category, cur_time, prev_time, cur_count, prev_count, "
                + _r(_METRIC_DOUBLES))
_PSPACE = PY_SPACE_CLASS
_LB = LINE_BREAK_RE.replace("\\u2028", "\\x{2028}").replace("\\u2029", "\\x{2029}")
_REL = (f"^{_PSPACE}*(\\p{{Nd}}+{_PSPACE}*(분|시간|일)|\\p{{Nd}}+{_PSPACE}*phút"
        f"|\\p{{Nd}}+{_PSPACE}*giờ|\\p{{Nd}}+{_PSPACE}*ngày){_PSPACE}*$")


def _toks(x: str) -> str:
    return f"regexp_split_to_array({x}, '{_PSPACE}+')"


# Threads cleaner with list functions: the first token differing from the username
# is found by position (the Spark side uses a quoted-prefix regex instead).
_FIRST_OTHER = f"list_position(list_transform({_toks('l')}, lambda tk: tk <> u), true)"
CLEAN_THREADS = f"""CASE WHEN txt IS NULL OR txt = '' THEN txt ELSE array_to_string(
  list_filter(
    list_transform(
      list_filter(list_transform(regexp_split_to_array(txt, '{_LB}'),
                                 lambda l: regexp_replace(l, '^{_PSPACE}+|{_PSPACE}+$', '', 'g')),
                  lambda l: l <> ''),
      lambda l: CASE WHEN u IS NULL OR u = '' OR regexp_matches(u, '{_PSPACE}') THEN l
        WHEN {_FIRST_OTHER} = 1 THEN l
        ELSE array_to_string(list_slice({_toks('l')},
               coalesce(nullif({_FIRST_OTHER}, 0), len({_toks('l')}) + 1), len({_toks('l')})), ' ')
        END),
    lambda l: l <> '' AND NOT regexp_full_match(l, '{_REL}')),
  chr(10)) END"""



_LARGE_BAG = """SELECT p.collected_time, p.channel, p.query, 'c' || CAST(length(t.keyword) % 5 AS VARCHAR) AS category,
    count(*) AS count_category FROM posts p JOIN dtok t USING (doc_id) GROUP BY ALL"""


def _build(BUCKET: str, STEP_US: int, duration: float = 2.0, spike_bucket: str = Q.SPIKE_BUCKET,
           spike_threshold: float = Q.SPIKE_THRESHOLD) -> tuple[str, dict[str, str]]:
    """Shared CTE chain and per-query bodies for one set of parameters."""
    CTES = f"""
    WITH posts AS (
      SELECT e.event_id AS post_id, 'u' || CAST(e.user_id AS VARCHAR) AS username,
             e.ts AS uploaded_time, time_bucket(INTERVAL '{BUCKET}', e.ts) AS collected_time,
             CASE WHEN e.event_id % 2 = 0 THEN 'X' ELSE 'threads' END AS channel,
             e.event_type AS query, d.text AS text, d.lang AS lang,
             e.user_id AS user_id_, d.doc_id AS doc_id
      FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
    ),
    bag_raw(category, keyword) AS (VALUES {_BAG}),
    bag_ref AS (SELECT trim(lower(category)) AS category, trim(lower(keyword)) AS keyword FROM bag_raw),
    bag AS (SELECT DISTINCT category, keyword FROM bag_ref
            WHERE keyword IS NOT NULL AND keyword <> '' AND category IS NOT NULL),
    dclean AS (
      SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text,
               '[\\r\\n]+', ' ', 'g'), '[^A-Za-z0-9{_JSPACE}]', ' ', 'g'), '[{_JSPACE}]+', ' ', 'g'))
               AS clean_text
      FROM documents
    ),
    dwords AS (
      SELECT *, list_filter(string_split_regex(lower(clean_text), '\\W'), lambda x: length(x) >= 2) AS words
      FROM dclean
    ),
    dfiltered AS (
      SELECT *, list_filter(words, lambda x: NOT list_contains({_STOP}, lower(x))) AS filtered FROM dwords
    ),
    clean AS (SELECT p.post_id, d.clean_text FROM posts p JOIN dclean d USING (doc_id)),
    words AS (SELECT p.post_id, d.words FROM posts p JOIN dwords d USING (doc_id)),
    filtered AS (SELECT p.post_id, d.filtered FROM posts p JOIN dfiltered d USING (doc_id)),
    dtok AS (SELECT DISTINCT doc_id, keyword FROM (SELECT doc_id, unnest(filtered) AS keyword FROM dfiltered)),
    dmatched AS (SELECT * FROM dtok WHERE keyword IN (SELECT keyword FROM bag_ref)),
    matched AS (SELECT p.post_id, m.keyword FROM posts p JOIN dmatched m USING (doc_id)),
    hits AS (
      SELECT p.*, b.category, m.keyword FROM matched m JOIN bag b ON b.keyword = m.keyword
      JOIN posts p ON p.post_id = m.post_id
    ),
    misses AS (
      SELECT p.*, 'no' AS category, 'no' AS keyword FROM posts p
      WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.post_id = p.post_id)
    ),
    mapped AS (SELECT * FROM hits UNION ALL SELECT * FROM misses),
    kw AS (
      SELECT collected_time, channel, query, category, keyword, count(*) AS count_keyword
      FROM hits WHERE category <> 'no' GROUP BY ALL
    ),
    cat AS (
      SELECT collected_time, channel, query, category, count(*) AS count_category
      FROM hits WHERE category <> 'no' GROUP BY ALL
    ),
    mr_base AS (
      SELECT channel, query, category, collected_time AS cur_time, count_category AS cur_count,
        lag(collected_time) OVER s AS prev_time, lag(count_category) OVER s AS prev_count,
        avg(count_category) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS avg_long,
        stddev_samp(count_category) OVER (s ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS sd_vol,
        avg(count_category) OVER (s ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS avg_vol,
        sum(count_category) OVER (PARTITION BY channel, query, collected_time) AS total
      FROM cat WINDOW s AS (PARTITION BY channel, query, category ORDER BY collected_time)
    ),
    mr_g AS (
      SELECT *,
        CAST(cur_count - prev_count AS DOUBLE) / (CASE WHEN prev_count > 0 THEN prev_count ELSE 1 END)
          AS short_term_growth,
        cur_count / NULLIF(avg_long, 0) AS long_term_ratio,
        sd_vol / NULLIF(avg_vol, 0) AS volatility,
        CAST(cur_count AS DOUBLE) / NULLIF(total, 0) AS ratio_to_total
      FROM mr_base
    ),
    mr_a AS (
      SELECT *, short_term_growth - lag(short_term_growth) OVER
        (PARTITION BY channel, query, category ORDER BY cur_time) AS acceleration
      FROM mr_g
    ),
    metrics_rows AS (
      SELECT channel, query, category, cur_time, prev_time, CAST(cur_count AS INTEGER) AS cur_count,
        CAST(prev_count AS INTEGER) AS prev_count, short_term_growth, long_term_ratio, volatility,
        ratio_to_total, acceleration, {_score()} AS score
      FROM mr_a
    ),
    mt_slots AS (
      SELECT channel, query, category, collected_time, count_category,
    {_slots(STEP_US)},
        sum(count_category) OVER (PARTITION BY channel, query, collected_time) AS total
      FROM (SELECT *, epoch_us(collected_time) AS eu FROM cat)
      WINDOW s AS (PARTITION BY channel, query, category ORDER BY eu)
    ),
    mt_1 AS (
      SELECT *, coalesce(count_category, 0) AS cur,
        CASE WHEN {_truthy('slot_1')} THEN slot_1 ELSE 1 END AS prev_count
      FROM mt_slots
    ),
    mt_2 AS (
      SELECT *, {_growth('cur', 'prev_count')} AS short_term_growth,
        {_N3} AS n3, {_S3} AS s3, {_N6} AS n6, CAST({_S6} AS DOUBLE) / NULLIF({_N6}, 0) AS mu6
      FROM mt_1
    ),
    mt_3 AS (
      SELECT *,
        CASE WHEN n3 = 0 THEN 0.0 ELSE cur / (CAST(s3 AS DOUBLE) / n3) END AS long_term_ratio,
        CASE WHEN n6 < 2 OR mu6 <= 0 THEN 0.0 ELSE sqrt(({' + '.join(
            ['0.0'] + [f'coalesce(({p} - mu6) * ({p} - mu6), 0.0)' for p in _P6])}) / (n6 - 1)) / mu6
          END AS volatility,
        CASE WHEN total > 0 THEN CAST(cur AS DOUBLE) / total ELSE 0.0 END AS ratio_to_total,
        CASE WHEN slot_2 IS NOT NULL THEN {_growth('prev_count', 'slot_2')} END AS prev_growth,
        list_slice(list_filter({_chain_growths()}, lambda x: x IS NOT NULL), 1, 3) AS latest3
      FROM mt_2
    ),
    metrics_time AS (
      SELECT channel, query, category, collected_time AS cur_time,
        collected_time - INTERVAL '{BUCKET}' AS prev_time,
        CAST(cur AS INTEGER) AS cur_count, CAST(prev_count AS INTEGER) AS prev_count,
        short_term_growth, long_term_ratio, volatility, ratio_to_total,
        CASE WHEN prev_growth IS NULL THEN 0.0 ELSE short_term_growth - prev_growth END AS acceleration,
        {_score(a="(CASE WHEN prev_growth IS NULL THEN 0.0 ELSE short_term_growth - prev_growth END)")}
          AS score,
        CASE WHEN len(latest3) = 3 AND len(list_filter(latest3, lambda x: x > {duration})) = 3 THEN 1 ELSE 0 END
          AS duration_flag,
        CASE WHEN slot_1 IS NOT NULL AND slot_2 IS NOT NULL AND slot_3 IS NOT NULL
             AND cur > slot_1 AND slot_1 > slot_2 AND slot_2 > slot_3 THEN 1 ELSE 0 END AS rising_flag
      FROM mt_3
    ),
    alerts AS (
      SELECT r.channel, r.query, r.category, r.cur_time, r.prev_time, r.cur_count, r.prev_count,
        c.keyword, c.count_keyword, r.short_term_growth, r.long_term_ratio, r.ratio_to_total,
        r.acceleration, r.score
      FROM metrics_rows r JOIN kw c ON r.cur_time = c.collected_time AND r.channel = c.channel
        AND r.query = c.query AND r.category = c.category
      WHERE r.score > 2.0
    ),
    alerts_time AS (
      SELECT r.channel, r.query, r.category, r.cur_time, r.prev_time, r.cur_count, r.prev_count,
        c.keyword, c.count_keyword, r.short_term_growth, r.long_term_ratio, r.ratio_to_total,
        r.acceleration, r.score
      FROM metrics_time r JOIN kw c ON r.cur_time = c.collected_time AND r.channel = c.channel
        AND r.query = c.query AND r.category = c.category
      WHERE r.score > 2.0
    ),
    bc AS (
      SELECT channel, time_bucket(INTERVAL '{spike_bucket}', uploaded_time) AS bucket_ts,
             count(*) AS cnt
      FROM posts WHERE uploaded_time IS NOT NULL GROUP BY ALL
    ),
    sp1 AS (
      SELECT *, lag(cnt) OVER w AS prev_cnt,
        CASE WHEN count(cnt) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 3
             THEN avg(cnt) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS count_ma
      FROM bc WINDOW w AS (PARTITION BY channel ORDER BY bucket_ts)
    ),
    sp2 AS (
      SELECT *,
        CASE WHEN prev_cnt IS NULL OR prev_cnt <= 0 THEN 0.0
             ELSE CAST(cnt - prev_cnt AS DOUBLE) / prev_cnt * 100 END AS growth,
        (count_ma / NULLIF(lag(count_ma) OVER w, 0) - 1) * 100 AS growth_rate_ma
      FROM sp1 WINDOW w AS (PARTITION BY channel ORDER BY bucket_ts)
    ),
    sp3 AS (
      SELECT *, CAST(growth >= {spike_threshold} AS INTEGER) AS exceed FROM sp2
    ),
    sp4 AS (
      SELECT *, sum(1 - exceed) OVER (PARTITION BY channel ORDER BY bucket_ts
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM sp3
    ),
    spikes AS (
      SELECT *, CAST(CASE WHEN exceed = 1 THEN sum(exceed) OVER (PARTITION BY channel, island
                  ORDER BY bucket_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END
                  AS INTEGER) AS streak
      FROM sp4
    ),
    """


    BODIES: dict[str, str] = {
        # text
        "preprocess_text": "SELECT post_id, clean_text FROM clean",
        "tokenize": f"SELECT post_id, {_TOK_OUT.format(a='words')} FROM words",
        "tokenize_fused": f"SELECT post_id, {_TOK_OUT.format(a='words')} FROM words",
        "remove_stopwords": f"SELECT post_id, {_TOK_OUT.format(a='filtered')} FROM filtered",
        "lower_tokens": "SELECT post_id, "
                        + _TOK_OUT.format(a="list_transform(string_split(clean_text, ' '), lambda x: lower(x))")
                        + " FROM clean",
        # matching
        "map_with_wordbag": f"SELECT {_MAP8} FROM mapped",
        "map_with_wordbag_join": f"SELECT {_MAP8} FROM mapped",
        # counts
        "count_category": "SELECT * FROM cat",
        "count_keyword": "SELECT * FROM kw",
        "category_keyword_counts": """SELECT k.collected_time, k.channel, k.query, k.category,
            k.keyword, c.count_category, k.count_keyword FROM kw k JOIN cat c
            USING (collected_time, channel, query, category)""",
        "top_keywords": f"""SELECT k.collected_time, k.channel, k.query, k.category,
            k.keyword, c.count_category, k.count_keyword FROM kw k JOIN cat c
            USING (collected_time, channel, query, category)
            ORDER BY c.count_category DESC, k.count_keyword DESC, k.collected_time, k.channel,
                     k.query, k.category, k.keyword LIMIT {Q.TOP_K}""",
        "distinct_counts": "SELECT DISTINCT * FROM cat",
        "total_count": """SELECT *, sum(count_category) OVER (PARTITION BY collected_time, channel, query)
            AS total_count FROM cat""",
        "bucket_counts": "SELECT channel, bucket_ts, cnt FROM bc",
        # metrics, rows mode
        "prev_count": f"SELECT {_KEYS}, prev_time, prev_count FROM metrics_rows",
        "short_term_growth": f"SELECT {_KEYS}, round(short_term_growth, 6) AS short_term_growth FROM metrics_rows",
        "long_term_ratio": f"SELECT {_KEYS}, round(long_term_ratio, 6) AS long_term_ratio FROM metrics_rows",
        "volatility": f"SELECT {_KEYS}, round(volatility, 6) AS volatility FROM metrics_rows",
        "ratio_to_total": f"SELECT {_KEYS}, round(ratio_to_total, 6) AS ratio_to_total FROM metrics_rows",
        "acceleration": f"SELECT {_KEYS}, round(acceleration, 6) AS acceleration FROM metrics_rows",
        "risk_score": f"SELECT {_KEYS}, round(score, 6) AS score FROM metrics_rows",
        "metrics_rows": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        # metrics, time mode
        "exact_lag": f"""SELECT channel, query, category, collected_time AS cur_time,
            {', '.join(f'slot_{k}' for k in range(1, 7))} FROM mt_slots""",
        "growth_time": f"SELECT {_KEYS}, prev_time, prev_count, round(short_term_growth, 6) AS short_term_growth FROM metrics_time",
        "long_ratio_time": f"SELECT {_KEYS}, round(long_term_ratio, 6) AS long_term_ratio FROM metrics_time",
        "volatility_time": f"SELECT {_KEYS}, round(volatility, 6) AS volatility FROM metrics_time",
        "share_time": f"SELECT {_KEYS}, round(ratio_to_total, 6) AS ratio_to_total FROM metrics_time",
        "accel_time": f"SELECT {_KEYS}, round(acceleration, 6) AS acceleration FROM metrics_time",
        "duration_flag": f"SELECT {_KEYS}, duration_flag FROM metrics_time",
        "rising_flag": f"SELECT {_KEYS}, rising_flag FROM metrics_time",
        "metrics_time": f"SELECT {_METRICS_OUT}, duration_flag, rising_flag FROM metrics_time",
        # spikes
        "bucket_growth": "SELECT channel, bucket_ts, cnt, prev_cnt, round(growth, 6) AS growth FROM spikes",
        "centered_ma": "SELECT channel, bucket_ts, cnt, round(count_ma, 6) AS count_ma FROM spikes",
        "ma_growth": """SELECT channel, bucket_ts, round(count_ma, 6) AS count_ma,
            round(growth_rate_ma, 6) AS growth_rate_ma FROM spikes""",
        "spikes_pieces": """SELECT channel, bucket_ts, cnt, prev_cnt, round(growth, 6) AS growth, round(count_ma, 6) AS count_ma,
            round(growth_rate_ma, 6) AS growth_rate_ma, exceed, streak FROM spikes""",
        "exceed_streak": "SELECT channel, bucket_ts, round(growth, 6) AS growth, exceed, streak FROM spikes",
        "exceed_streak_reference": """SELECT channel, bucket_ts, round(growth, 6) AS growth, exceed,
            CAST(CASE WHEN exceed = 1 THEN streak + (CASE WHEN island > 0 THEN 1 ELSE 0 END) ELSE 0 END
                 AS INTEGER) AS streak FROM spikes""",
        "streak_alerts": """SELECT channel, bucket_ts, cnt, prev_cnt, round(growth, 6) AS growth,
            round(count_ma, 6) AS count_ma, round(growth_rate_ma, 6) AS growth_rate_ma, exceed, streak
            FROM spikes WHERE streak >= 3""",
        # alerts
        "risk_rows": f"SELECT {_METRICS_OUT} FROM metrics_rows WHERE score > 2.0",
        "risk_rows_sustained": f"""SELECT {_METRICS_OUT}, duration_flag, rising_flag FROM metrics_time
            WHERE score > {Q.LOW_SCORE} AND duration_flag = 1""",
        "extract_alert": f"SELECT {_ALERT_OUT} FROM alerts",
        "extract_alert_daily": f"SELECT {_ALERT_OUT} FROM alerts",
        "extract_alert_time": f"SELECT {_ALERT_OUT} FROM alerts_time",
        "alert_items": "SELECT * FROM items",
        "new_alerts": "SELECT * FROM new_items",
        "alert_groups": "SELECT * FROM groups",
        "alert_message": f"SELECT pk, channel, query, category, cur_time, {MESSAGE} AS message FROM groups",
        # standardization
        "parse_created_at": """SELECT post_id, created_at, CAST(coalesce(
              CASE WHEN regexp_matches(created_at, '^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) ')
                   THEN try_strptime(created_at, '%a %b %d %H:%M:%S %z %Y') END,
              CASE WHEN regexp_matches(created_at, '^\\d{4}-\\d{2}-\\d{2}')
                   THEN TRY_CAST(created_at AS TIMESTAMPTZ) END) AT TIME ZONE 'UTC' AS TIMESTAMP)
              AS created_utc
            FROM (SELECT post_id, CASE user_id_ % 3
                WHEN 0 THEN strftime(uploaded_time, '%a %b %d %H:%M:%S +0000 %Y')
                WHEN 1 THEN strftime(uploaded_time + INTERVAL '9 hours', '%Y-%m-%dT%H:%M:%S') || '+09:00'
                ELSE 'Xyz ' || strftime(uploaded_time, '%b %d %H:%M:%S %Y') END AS created_at
              FROM posts)""",
        "iso_to_epoch": """SELECT post_id, iso, CASE
              WHEN NOT regexp_matches(iso, '^\\d{4}-\\d{2}-\\d{2}') THEN NULL
              WHEN regexp_matches(iso, '(Z|[+-]\\d\\d:\\d\\d)$')
                THEN CAST(floor(epoch(TRY_CAST(iso AS TIMESTAMPTZ))) AS BIGINT)
              ELSE CAST(floor(epoch(TRY_CAST(iso AS TIMESTAMP))) AS BIGINT) END AS epoch
            FROM (SELECT post_id, CASE user_id_ % 4
                WHEN 0 THEN strftime(uploaded_time, '%Y-%m-%dT%H:%M:%S') || 'Z'
                WHEN 1 THEN strftime(uploaded_time - INTERVAL '5 hours', '%Y-%m-%dT%H:%M:%S') || '-05:00'
                WHEN 2 THEN strftime(uploaded_time, '%Y-%m-%dT%H:%M:%S')
                ELSE 'not a time ' || username END AS iso FROM posts)""",
        "epoch_to_iso": """SELECT post_id, epoch, CASE WHEN epoch IS NULL OR epoch = 0 THEN ''
              ELSE strftime(make_timestamp(epoch * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS iso
            FROM (SELECT post_id, CAST(CASE WHEN user_id_ % 10 = 0 THEN 0
                    ELSE floor(epoch(uploaded_time)) END AS BIGINT) AS epoch FROM posts)""",
        "date_to_epoch": """SELECT post_id, day,
              CAST(epoch(try_strptime(day, '%Y-%m-%d')) AS BIGINT) AS epoch
            FROM (SELECT post_id, CASE WHEN user_id_ % 6 = 0 THEN strftime(uploaded_time, '%Y-%m-%d') || 'x'
                  ELSE strftime(uploaded_time, '%Y-%m-%d') END AS day FROM posts)""",
        "recent_posts": f"""SELECT post_id, uploaded_time, collected_time FROM posts
            WHERE uploaded_time BETWEEN collected_time + INTERVAL '{BUCKET}' - INTERVAL '10 minutes'
                                    AND collected_time + INTERVAL '{BUCKET}'""",
        "date_range_posts": f"""SELECT post_id, uploaded_time FROM posts
            WHERE uploaded_time >= TIMESTAMP '{Q.RANGE_SINCE}' AND uploaded_time < TIMESTAMP '{Q.RANGE_UNTIL}'""",
        "lang_filter": "SELECT post_id, lang FROM posts WHERE lang = 'en'",
        "lang_filter_lenient": """SELECT post_id, lang FROM (SELECT post_id, CASE WHEN lang = 'de' THEN NULL
              WHEN lang = 'es' THEN '' ELSE lang END AS lang FROM posts)
            WHERE lang IS NULL OR lang = '' OR lang = 'en'""",
        "query_in_text": f"SELECT post_id, q AS query FROM {_SPOKEN} WHERE contains(lower(text), lower(q))",
        "flatten_text": f"""SELECT post_id, regexp_replace(replace(coalesce(text, ''), chr(10), ' '),
            '^{_PSPACE}+|{_PSPACE}+$', '', 'g') AS flat_text FROM posts""",
        "clean_post_text": f"""SELECT post_id, {CLEAN_THREADS} AS clean_text FROM (
            SELECT post_id, username AS u, username || ' ' || username || ' ' || text || chr(10)
                   || '  3시간  ' || chr(10) AS txt FROM posts)""",
        "drop_empty_posts": """SELECT post_id FROM (SELECT post_id,
              CASE WHEN user_id_ % 3 = 0 THEN '' ELSE username END AS u,
              CASE WHEN lang = 'de' THEN NULL ELSE text END AS t FROM posts)
            WHERE (u IS NOT NULL AND u <> '') OR (t IS NOT NULL AND t <> '')""",
        "dedupe_page": """SELECT post_id, collected_time, channel, query, uploaded_time FROM (
              SELECT post_id, collected_time, channel, query, date_trunc('hour', uploaded_time) AS uploaded_time,
                row_number() OVER (PARTITION BY collected_time, channel, query, date_trunc('hour', uploaded_time)
                                   ORDER BY post_id) AS rn FROM posts) WHERE rn = 1""",
        "dedupe_posts": """SELECT post_id, uploaded_time, username FROM (
              SELECT post_id, date_trunc('hour', uploaded_time) AS uploaded_time,
                'u' || CAST(user_id_ % 7 AS VARCHAR) AS username FROM posts)
            QUALIFY row_number() OVER (PARTITION BY uploaded_time, username ORDER BY post_id) = 1""",
        "stamp_posts": f"""SELECT 'u' || CAST(user_id AS VARCHAR) AS username, ts AS uploaded_time,
            event_type AS query, event_id, 'X' AS channel,
            time_bucket(INTERVAL '{BUCKET}', ts) AS collected_time FROM events""",
        "cap_per_query": f"""SELECT post_id, query, uploaded_time FROM posts QUALIFY row_number() OVER
            (PARTITION BY time_bucket(INTERVAL '{Q.LONG_BUCKET}', uploaded_time), channel, query
             ORDER BY uploaded_time DESC, post_id) <= {Q.CAP}""",
        "batch_stats": f"""SELECT query, collected_time, max(uploaded_time) AS newest,
            min(uploaded_time) AS oldest,
            coalesce(bool_or(uploaded_time < TIMESTAMP '{Q.RANGE_UNTIL}'), false) AS any_older,
            count(*) AS n_posts FROM posts GROUP BY query, collected_time""",
        "collect_summary": f"""SELECT q.query, CAST(coalesce(s.saved, 0) AS BIGINT) AS saved,
            CAST(sum(coalesce(s.saved, 0)) OVER () AS BIGINT) AS total_saved,
            sum(coalesce(s.saved, 0)) OVER () > 0 AS ok
            FROM (SELECT DISTINCT q AS query FROM {_SPOKEN}) q
            LEFT JOIN (SELECT q AS query, count(*) AS saved FROM {_SPOKEN}
                       WHERE contains(lower(text), lower(q)) GROUP BY q) s USING (query)""",
        # sources and sinks
        "complete_batches": f"""SELECT strftime(uploaded_time, '%Y%m%d') AS batch,
            count(DISTINCT channel || '-' || query) AS n_files, {Q.EXPECTED_FILES} AS expected_files
            FROM posts WHERE NOT (channel = 'X' AND starts_with(query, 'c') AND day(uploaded_time) % 3 = 0)
            GROUP BY 1 HAVING count(DISTINCT channel || '-' || query) >= {Q.EXPECTED_FILES}""",
        "partition_by_query": """SELECT post_id, query || ' / ' || channel AS query,
            translate(query || ' / ' || channel, '/ ', '_-') AS keyword FROM posts""",
        "counts_upsert": f"""SELECT collected_time, channel, query, category,
            arg_max(count_category, v) AS count_category FROM (
              SELECT collected_time, channel, query, category, count(*) AS count_category, 0 AS v
                FROM hits WHERE category <> 'no' AND uploaded_time < TIMESTAMP '{Q.UPSERT_OLD_BEFORE}'
                GROUP BY ALL
              UNION ALL
              SELECT collected_time, channel, query, category, count(*) AS count_category, 1 AS v
                FROM hits WHERE category <> 'no' AND uploaded_time >= TIMESTAMP '{Q.UPSERT_NEW_FROM}'
                GROUP BY ALL)
            GROUP BY collected_time, channel, query, category""",
        # streaming: equal to the batch results
        "stream_posts": """SELECT post_id, username, uploaded_time, collected_time, channel, query, text, lang
            FROM posts""",
        "stream_counts": "SELECT * FROM cat",
        "stream_counts_late": "SELECT * FROM cat",
        "stream_final_counts": f"""SELECT *, CASE
              WHEN collected_time >= TIMESTAMP '{Q.STREAM_SLICES[0]}' AND collected_time < TIMESTAMP '{Q.STREAM_SLICES[1]}'
              THEN 'late'
              WHEN collected_time + INTERVAL '{BUCKET}' <= (SELECT max(collected_time) FROM cat) - INTERVAL '{Q.FINAL_DELAY}'
              THEN 'final' ELSE 'open' END AS status FROM cat""",
        "stream_counts_large_bag": _LARGE_BAG,
        "count_category_large_bag": _LARGE_BAG,
        "stream_recent": """SELECT post_id, uploaded_time, collected_time FROM posts
            WHERE uploaded_time BETWEEN collected_time + INTERVAL '20 minutes' AND collected_time + INTERVAL '30 minutes'""",
        "stream_alerts_new": f"SELECT pk, channel, query, category, cur_time, {MESSAGE} AS message FROM groups",
        "job_batches_rows": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "job_corrected_batch": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "stream_complete_batches": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "job_batches_time": f"SELECT {_METRICS_OUT} FROM metrics_time",
        "job_late_batch": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "job_same_snapshot": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "match_keywords_join": """SELECT p.post_id, coalesce(m.matched, '') AS matched,
            coalesce(m.n, 0) AS n_matched FROM (SELECT post_id FROM posts UNION ALL SELECT post_id FROM posts) p LEFT JOIN (
              SELECT post_id, string_agg(keyword, ' ' ORDER BY keyword) AS matched,
                     CAST(count(*) AS BIGINT) AS n FROM matched GROUP BY post_id) m
            ON m.post_id = p.post_id""",
        "wordbag_normalize": """SELECT DISTINCT trim(lower(' ' || upper(lang) || ' ')) AS category,
            trim(lower(split_part(text, ' ', 1) || '  ')) AS keyword FROM documents
            WHERE lang IS NOT NULL AND trim(split_part(text, ' ', 1)) <> ''""",
        "ranked_keywords": """SELECT k.collected_time, k.channel, k.query, k.category,
            k.keyword, c.count_category, k.count_keyword, row_number() OVER (
              ORDER BY c.count_category DESC, k.count_keyword DESC, k.collected_time, k.channel,
                       k.query, k.category, k.keyword) AS rank
            FROM kw k JOIN cat c USING (collected_time, channel, query, category)""",
        "write_posts": """SELECT username, CAST(uploaded_time AS VARCHAR) AS uploaded_time,
            CAST(collected_time AS VARCHAR) AS collected_time, channel, query, text FROM posts""",
        "read_posts_legacy": """SELECT username, date_trunc('second', uploaded_time) AS uploaded_time,
            collected_time, channel, query, text FROM posts""",
        "stream_counts_csv": "SELECT * FROM cat",
        "stream_metrics": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "stream_metrics_time": f"SELECT {_METRICS_OUT}, duration_flag, rising_flag FROM metrics_time",
        "stream_dedupe": """SELECT DISTINCT date_trunc('hour', uploaded_time) AS uploaded_time,
            'u' || CAST(user_id_ % 7 AS VARCHAR) AS username FROM posts""",
        "stream_alerts_once": f"SELECT pk, channel, query, category, cur_time, {MESSAGE} AS message FROM groups_all",
        "stream_alerts": f"SELECT pk, channel, query, category, cur_time, {MESSAGE} AS message FROM groups_all",
        "merge_posts": f"""SELECT username, CAST(uploaded_time AS VARCHAR) AS uploaded_time,
            CAST(collected_time AS VARCHAR) AS collected_time, channel,
            CASE WHEN uploaded_time >= TIMESTAMP '{Q.RANGE_UNTIL}' THEN query END AS query, text
            FROM posts""",
        "merge_posts_mixed": f"""SELECT username, CAST(uploaded_time AS VARCHAR) AS uploaded_time,
            CAST(collected_time AS VARCHAR) AS collected_time, channel,
            CASE WHEN uploaded_time >= TIMESTAMP '{Q.RANGE_UNTIL}' THEN query END AS query, text
            FROM posts""",
        "write_mapped": f"SELECT {_MAP8} FROM mapped",
        "metrics_sink": f"SELECT {_METRICS_OUT} FROM metrics_rows",
        "score_growth_only": f"SELECT {_KEYS}, round(short_term_growth, 6) AS score FROM metrics_time",
        "query_list": "SELECT DISTINCT event_type AS query FROM events",
        "batch_time": """SELECT username, uploaded_time, channel, query, collected_time AS batch_time
            FROM posts""",
        "read_posts": "SELECT username, uploaded_time, collected_time, channel, query, text FROM posts",
        "read_posts_split": """SELECT username, uploaded_time, collected_time, channel, query,
            'said ""' || chr(10) || text || chr(10) || '"end"' AS text FROM posts""",
        "metric_series": f"""SELECT {_METRICS_OUT} FROM metrics_rows
            WHERE channel = '{Q.SERIES_PICK[0]}' AND query = '{Q.SERIES_PICK[1]}'
              AND category = '{Q.SERIES_PICK[2]}'
              AND cur_time BETWEEN TIMESTAMP '{Q.SERIES_PICK[3]}' AND TIMESTAMP '{Q.SERIES_PICK[4]}'""",
    }
    return CTES, BODIES


# Queries that run with other parameters than the defaults.
# Matched keywords need ids and tokens only: own CTEs, without the posts' texts.
_MATCHES = f"""
    WITH bag_raw(category, keyword) AS (VALUES {_BAG}),
    bag AS (SELECT DISTINCT trim(lower(category)) AS category, trim(lower(keyword)) AS keyword FROM bag_raw),
    usable AS (SELECT * FROM bag WHERE length(keyword) >= 2 AND NOT list_contains({_STOP}, keyword)),
    tokens AS MATERIALIZED (
      SELECT DISTINCT doc_id, unnest(string_split(lower(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), ' ')) AS keyword
      FROM documents
    ),
    found AS MATERIALIZED (SELECT * FROM tokens WHERE keyword IN (SELECT keyword FROM usable)),
    ids AS MATERIALIZED (SELECT event_id AS post_id, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events)
"""
_MATCH_BODIES = {
    "match_keywords": """SELECT p.post_id, coalesce(m.matched, '') AS matched, coalesce(m.n, 0) AS n_matched
        FROM ids p LEFT JOIN (
          SELECT doc_id, string_agg(keyword, ' ' ORDER BY keyword) AS matched, CAST(count(*) AS BIGINT) AS n
          FROM found GROUP BY doc_id) m USING (doc_id)""",
    "keyword_hits": """SELECT p.post_id, f.keyword, u.category
        FROM ids p JOIN found f USING (doc_id) JOIN usable u ON u.keyword = f.keyword""",
    "keyword_misses": """SELECT p.post_id, 'no' AS category, 'no' AS keyword
        FROM ids p WHERE p.doc_id NOT IN (SELECT doc_id FROM found)""",
}

_LONG = {"BUCKET": Q.LONG_BUCKET, "STEP_US": interval_seconds(Q.LONG_BUCKET) * 1_000_000, "duration": Q.LOW_DURATION}
_OTHER = {"duration_flag": _LONG, "rising_flag": _LONG, "risk_rows_sustained": _LONG,
          "extract_alert_daily": _LONG,
          "streak_alerts": {"spike_bucket": Q.STREAK_BUCKET, "spike_threshold": Q.STREAK_THRESHOLD}}


def oracle_sql() -> dict[str, str]:
    """Key -> full DuckDB SQL (shared CTE chain + the query body)."""
    own = {"BUCKET": BUCKET, "STEP_US": interval_seconds(BUCKET) * 1_000_000}

    def full(**kwargs) -> dict[str, str]:
        ctes, bodies = _build(**(own | kwargs))
        prefix = (ctes + ITEMS).rstrip().rstrip(",") + "\n"
        return {k: prefix + v for k, v in bodies.items()}

    sql = full()
    for key, kwargs in _OTHER.items():
        sql[key] = full(**kwargs)[key]
    sql |= {key: _MATCHES + body for key, body in _MATCH_BODIES.items()}
    sql["counts_upsert_path"] = sql["counts_upsert"]
    sql["metric_series_stored"] = sql["metric_series"]
    sql["metrics_rows_pieces"] = sql["metrics_rows"]
    sql["exceed_streak_reference_pieces"] = sql["exceed_streak_reference"]
    return {k: v for k, v in sql.items() if k not in Q.NO_ORACLE}
