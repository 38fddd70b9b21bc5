"""SQL that states what each registered query must return."""

from __future__ import annotations

import datetime as dt

from tidemark.registry.queries import (
    ACTIVE_DAYS,
    INGEST_DATE,
    RUN_DAYS,
    SAMPLE_ROWS,
    SAMPLE_SEED,
    SECOND_RUN,
    YEAR,
)
from tidemark.sources.adapter import SUPPLIER_USERS_FROM

GAP = "INTERVAL 30 MINUTE"
NEXT_DATE = INGEST_DATE + dt.timedelta(days=1)


def _ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


# Common table expressions; each query takes those it needs.
CTE = {
    "event": """
        SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
               ts AS created_at,
               CASE event_type WHEN 'purchase' THEN 'like' ELSE event_type END AS event_type,
               CAST(CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS is_like,
               CAST(ts AS DATE) AS partition_date
        FROM events""",
    "usr": """
        SELECT c_custkey AS user_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               TIMESTAMP '2023-12-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS created_at,
               TIMESTAMP '2023-12-01' + to_days(CAST(c_custkey % 30 AS INTEGER))
                   + to_hours(c_custkey % 24) AS updated_at,
               CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2023-12-01'
                   + to_days(CAST(c_custkey % 30 AS INTEGER)) + to_hours(c_custkey % 24)
               END AS deleted_at,
               CAST(c_nationkey AS VARCHAR) AS country_code,
               nullif(c_mktsegment, 'MACHINERY') AS favorite_color
        FROM customer""",
    "post": """
        SELECT p_partkey AS post_id,
               p_partkey % (SELECT count(*) FROM customer) AS user_id, p_name AS post_text,
               TIMESTAMP '2024-01-01' + to_days(CAST(p_partkey % 30 AS INTEGER))
                   + to_hours(p_size) AS created_at,
               CASE WHEN p_size > 45 THEN TIMESTAMP '2024-01-01'
                   + to_days(CAST(p_partkey % 30 AS INTEGER)) + to_hours(p_size)
               END AS deleted_at
        FROM part""",
    "int_user": """
        SELECT user_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
               coalesce(country_code, 'Unknown') AS country_code,
               coalesce(n_name, 'Unknown') AS country, coalesce(r_name, 'Unknown') AS region,
               coalesce(favorite_color, 'Unknown') AS fav_color,
               created_at, updated_at, deleted_at
        FROM usr LEFT JOIN (
            SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name, r_name
            FROM nation JOIN region ON n_regionkey = r_regionkey) USING (country_code)""",
    "int_merged": """
        SELECT user_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
               coalesce(country_code, 'Unknown') AS country_code,
               coalesce(n_name, 'Unknown') AS country, coalesce(r_name, 'Unknown') AS region,
               coalesce(favorite_color, 'Unknown') AS fav_color,
               created_at, updated_at, deleted_at
        FROM merged LEFT JOIN (
            SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name, r_name
            FROM nation JOIN region ON n_regionkey = r_regionkey) USING (country_code)""",
    "int_post": """
        SELECT post_id, post_text, u.country_code AS creator_country_code,
               u.country AS creator_country, u.region AS creator_region,
               u.fav_color AS creator_fav_color, p.created_at, p.created_at AS updated_at,
               p.deleted_at, p.user_id AS creator_id
        FROM post p LEFT JOIN int_user u USING (user_id)""",
    "agg_post": """
        SELECT partition_date AS event_date, post_id, CAST(sum(is_like) AS BIGINT) AS likes,
               count(DISTINCT CASE WHEN is_like = 0 THEN user_id END) AS views
        FROM event GROUP BY ALL""",
    "agg_user": """
        SELECT partition_date AS event_date, user_id,
               count(DISTINCT CASE WHEN is_like = 1 THEN post_id END) AS likes_given,
               count(DISTINCT CASE WHEN is_like = 0 THEN post_id END) AS posts_viewed
        FROM event GROUP BY ALL""",
    "dim_post": """
        SELECT p.* EXCLUDE (deleted_at), CAST(coalesce(likes, 0) AS BIGINT) AS likes,
               CAST(coalesce(views, 0) AS BIGINT) AS views
        FROM int_post p LEFT JOIN (
            SELECT post_id, sum(likes) AS likes, sum(views) AS views
            FROM agg_post GROUP BY post_id) USING (post_id)
        WHERE deleted_at IS NULL""",
    "creator": """
        SELECT creator_id AS user_id, CAST(sum(likes) AS BIGINT) AS total_likes,
               CAST(sum(views) AS BIGINT) AS total_views
        FROM dim_post GROUP BY creator_id""",
    "feed": """
        SELECT user_id, ts AS updated_at, r_name AS region, event_id AS change_id
        FROM events LEFT JOIN region
            ON r_regionkey = CAST(json_extract_string(props, '$.k') AS BIGINT) % 5
        WHERE event_type = 'signup'""",
    "version": """
        SELECT user_id, region, updated_at, updated_at AS valid_from,
               lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to
        FROM (SELECT * FROM feed QUALIFY row_number() OVER (
            PARTITION BY user_id, updated_at ORDER BY change_id DESC) = 1)""",
    "presence": """
        SELECT user_id, ts AS updated_at,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS score,
               event_type = 'signup' AS present, event_id AS change_id
        FROM events WHERE event_type IN ('signup', 'error')""",
    "run": f"""
        SELECT unnest(generate_series(first + INTERVAL {RUN_DAYS} DAY,
                      last + INTERVAL {RUN_DAYS} DAY, INTERVAL {RUN_DAYS} DAY)) AS run_ts
        FROM (SELECT CAST(CAST(min(updated_at) AS DATE) AS TIMESTAMP) AS first,
                     CAST(CAST(max(updated_at) AS DATE) AS TIMESTAMP) AS last FROM presence)""",
    "state": """
        SELECT run_ts, user_id, arg_max(present, (updated_at, change_id)) AS present,
               arg_max(score, (updated_at, change_id)) AS score, max(updated_at) AS updated_at
        FROM run JOIN presence ON updated_at < run_ts GROUP BY run_ts, user_id""",
    "middle": """
        SELECT min(partition_date)
               + CAST((max(partition_date) - min(partition_date)) // 2 AS INTEGER) AS day
        FROM event""",
    "merged": """
        SELECT user_id, u.first_name, u.last_name, u.created_at,
               CASE WHEN live AND d.at IS NOT NULL THEN d.at
                    WHEN live AND s.at IS NOT NULL THEN s.at ELSE u.updated_at END AS updated_at,
               CASE WHEN live AND d.at IS NOT NULL THEN d.at ELSE u.deleted_at END AS deleted_at,
               CASE WHEN live AND d.at IS NULL AND s.at IS NOT NULL
                    THEN CAST(s.k % 25 AS VARCHAR) ELSE u.country_code END AS country_code,
               CASE WHEN live AND d.at IS NULL AND s.color_at IS NOT NULL THEN s.color
                    ELSE u.favorite_color END AS favorite_color,
               CASE WHEN live AND d.at IS NOT NULL THEN 'deleted'
                    WHEN live AND s.at IS NOT NULL THEN 'updated' END AS applied
        FROM (SELECT *, deleted_at IS NULL AS live FROM usr) u
        LEFT JOIN (SELECT o_custkey AS user_id, max(o_orderdate) AS at FROM orders GROUP BY 1
                   HAVING arg_max(o_orderstatus, (o_orderdate, o_orderkey)) = 'F') d
            USING (user_id)
        LEFT JOIN (
            SELECT user_id, max(ts) AS at, arg_max(k, (ts, event_id)) AS k,
                   max(ts) FILTER (value > 10) AS color_at,
                   CASE WHEN arg_max(k, (ts, event_id)) FILTER (value > 10) >= 10
                        THEN 'COLOR_' || CAST(
                            arg_max(k, (ts, event_id)) FILTER (value > 10) AS VARCHAR)
                   END AS color
            FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
                  WHERE event_type = 'signup') GROUP BY user_id) s USING (user_id)
        UNION ALL
        SELECT s_suppkey + 1000000000, split_part(s_name, '#', 1), split_part(s_name, '#', 2),
               TIMESTAMP '2024-01-01' + to_hours(s_suppkey % 500),
               TIMESTAMP '2024-01-01' + to_hours(s_suppkey % 500), NULL,
               CAST(s_nationkey AS VARCHAR), NULL, 'inserted'
        FROM supplier""".replace("1000000000", str(SUPPLIER_USERS_FROM)),
    "session": f"""
        SELECT user_id, min(created_at) AS session_start, max(created_at) AS session_end,
               count(*) AS events
        FROM (SELECT user_id, created_at, sum(starts) OVER (
                  PARTITION BY user_id ORDER BY created_at) AS n
              FROM (SELECT user_id, created_at, CASE WHEN created_at - lag(created_at) OVER (
                        PARTITION BY user_id ORDER BY created_at) <= {GAP}
                    THEN 0 ELSE 1 END AS starts FROM event))
        GROUP BY user_id, n""",
}


def _with(names: str, select: str) -> str:
    parts = ", ".join(f"{name} AS ({CTE[name]})" for name in names.split())
    return f"WITH {parts} {select}"


def _mau(facts: str, ts: str) -> str:
    return f"""
        SELECT {_day(f"date_trunc('month', {ts})")} AS activity_month, region,
               count(DISTINCT f.user_id) AS mau
        FROM {facts} f LEFT JOIN version v
            ON f.user_id = v.user_id AND {ts} >= valid_from
            AND ({ts} < valid_to OR valid_to IS NULL)
        WHERE extract(year FROM {ts}) = {YEAR}
        GROUP BY ALL"""


_EVENT_OUT = f"""event_id, user_id, post_id, {_ts("created_at")} AS created_at, event_type,
    is_like, {_day("partition_date")} AS partition_date"""
_TIMES = f"""{_ts("created_at")} AS created_at, {_ts("updated_at")} AS updated_at"""
_DELETED = f"""{_ts("deleted_at")} AS deleted_at"""
_INTERVAL = f"""{_ts("valid_from")} AS valid_from, {_ts("valid_to")} AS valid_to,
    valid_to IS NULL AS is_current"""

_STG_EVENTS = _with("event", f"SELECT {_EVENT_OUT} FROM event")
_AGG_POST = _with(
    "event agg_post",
    f"SELECT {_day('event_date')} AS event_date, post_id, likes, views FROM agg_post",
)
_AGG_USER = _with(
    "event agg_user",
    f"""SELECT {_day('event_date')} AS event_date, user_id, likes_given, posts_viewed
        FROM agg_user""",
)
_APPLIED_CHANGES = _with(
    "usr merged",
    f"""SELECT * EXCLUDE (created_at, updated_at, deleted_at, applied), {_TIMES}, {_DELETED}
        FROM merged""",
)
_DIMS = "event usr post int_user int_post agg_post agg_user dim_post"


def _dim_users(names: str, users: str) -> str:
    return _with(
        f"{_DIMS} creator {names}",
        f"""
        SELECT u.* EXCLUDE (created_at, updated_at, deleted_at), {_TIMES},
               CAST(coalesce(likes_given, 0) AS BIGINT) AS likes_given,
               CAST(coalesce(posts_viewed, 0) AS BIGINT) AS posts_viewed,
               coalesce(total_likes, 0) AS total_likes, coalesce(total_views, 0) AS total_views
        FROM {users} u
        LEFT JOIN (SELECT user_id, sum(likes_given) AS likes_given,
                          sum(posts_viewed) AS posts_viewed
                   FROM agg_user GROUP BY user_id) USING (user_id)
        LEFT JOIN creator USING (user_id)
        WHERE deleted_at IS NULL""",
    )


_DAY_OF_FEED = """date_diff('day', (SELECT min(CAST(updated_at AS DATE)) FROM feed),
                          CAST(updated_at AS DATE))"""


def _runs(run: str) -> str:
    """History of which every run sees the last change of each user."""
    return _with(
        "feed",
        f"""
    SELECT user_id, region, {_INTERVAL} FROM (
        SELECT *, updated_at AS valid_from,
               lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to
        FROM (SELECT * FROM (SELECT *, {run} AS run FROM feed)
              QUALIFY row_number() OVER (PARTITION BY user_id, run
                  ORDER BY updated_at DESC, change_id DESC) = 1))""",
    )


_RUNS = _runs(f"{_DAY_OF_FEED} // {RUN_DAYS}")


def _activity(daily: str, key: str) -> str:
    return f"""
        SELECT {key}, {_day("max(event_date)")} AS last_active,
               max(event_date) > (SELECT max(event_date) FROM {daily}) - {ACTIVE_DAYS} AS is_active
        FROM {daily} GROUP BY {key}"""


# The batch with its times cut to days, so that many changes are at the same time.
_TIED = _with(
    "usr",
    f"""
    , gone AS (SELECT o_custkey AS user_id, max(date_trunc('day', o_orderdate)) AS at FROM orders
               GROUP BY 1 HAVING arg_max(o_orderstatus, (o_orderdate, o_orderkey)) = 'F'),
    signup AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_id, value,
                      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
               FROM events WHERE event_type = 'signup'),
    latest AS (
        SELECT user_id, max(day) AS at, arg_max(k, (day, event_id)) AS k,
               count(*) FILTER (value > 10) > 0 AS colored,
               arg_max(k, (day, event_id)) FILTER (value > 10) AS color FROM signup GROUP BY 1)
    SELECT u.user_id,
           {_ts("""CASE WHEN u.deleted_at IS NULL AND g.at IS NOT NULL THEN g.at
                   WHEN u.deleted_at IS NULL AND l.at IS NOT NULL THEN l.at
                   ELSE u.updated_at END""")} AS updated_at,
           CASE WHEN u.deleted_at IS NULL AND g.at IS NULL AND l.at IS NOT NULL
                THEN CAST(l.k % 25 AS VARCHAR) ELSE u.country_code END AS country_code,
           CASE WHEN u.deleted_at IS NULL AND g.at IS NULL AND l.colored
                THEN CASE WHEN l.color >= 10 THEN 'COLOR_' || CAST(l.color AS VARCHAR) END
                ELSE u.favorite_color END AS favorite_color
    FROM usr u LEFT JOIN gone g USING (user_id) LEFT JOIN latest l USING (user_id)
    UNION ALL
    SELECT s_suppkey + {SUPPLIER_USERS_FROM},
           {_ts("date_trunc('day', TIMESTAMP '2024-01-01' + to_hours(s_suppkey % 500))")},
           CAST(s_nationkey AS VARCHAR), NULL FROM supplier""",
)

# The declared tests, written out: (table, test, column), and how many fail.
_RAW_NULLS = {
    "user": ("user_id", "first_name", "last_name", "created_at", "country_code"),
    "post": ("post_id", "user_id", "post_text", "created_at"),
    "event": ("event_id", "user_id", "post_id", "created_at", "event_type"),
    "stg_events": ("event_id",),
    "dim_users": ("user_id", "country_code", "country", "region", "created_at", "updated_at"),
    "dim_posts": (
        "post_id", "creator_id", "creator_country_code", "creator_country", "creator_region",
        "created_at", "updated_at",
    ),
    "fct_events": (
        "event_id", "user_id", "post_id", "created_at", "event_type", "is_like", "partition_date",
    ),
}
_RAW_KEYS = {
    "user": "user_id", "post": "post_id", "event": "event_id", "stg_events": "event_id",
    "dim_users": "user_id", "dim_posts": "post_id", "fct_events": "event_id",
}


def _declared_tests() -> str:
    """Failures of every declared test over tables named ``bad_`` and their name."""
    parts = []
    for name, columns in _RAW_NULLS.items():
        for column in columns:
            parts.append((name, "not_null", column, f"FROM bad_{name} WHERE {column} IS NULL"))
    for name, key in _RAW_KEYS.items():
        repeated = f"SELECT {key} FROM bad_{name} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        parts.append((name, "unique", key, f"FROM ({repeated})"))
    for name in ("event", "fct_events"):
        others = f"FROM bad_{name} WHERE event_type NOT IN ('view', 'like')"
        parts.append((name, "accepted_values", "event_type", others))
    for name, key, parent in (("post", "user_id", "user"), ("event", "user_id", "user"), ("event", "post_id", "post")):
        orphans = f"FROM bad_{name} WHERE {key} NOT IN (SELECT {key} FROM bad_{parent})"
        parts.append((name, "relationships", key, orphans))
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{test}' AS test, '{column}' AS column_name,
            count(*) AS failures {rows}"""
        for name, test, column, rows in parts
    )


def _suite() -> str:
    return _with(
        _DIMS,
        f"""
        , bad_user AS (SELECT * FROM usr), bad_post AS (SELECT * FROM post),
        bad_event AS (SELECT * FROM event), bad_stg_events AS (SELECT * FROM event),
        bad_fct_events AS (SELECT * FROM event), bad_dim_posts AS (SELECT * FROM dim_post),
        bad_dim_users AS (SELECT * FROM int_user WHERE deleted_at IS NULL)
        {_declared_tests()}""",
    )


def _faults() -> str:
    """The same tests over faulty copies of the tables."""
    counts = _declared_tests()
    return _with(
        "event usr post",
        f"""
        , some_user AS (
            SELECT * REPLACE (CASE WHEN user_id % 11 <> 0 THEN first_name END AS first_name,
                              CASE WHEN user_id % 13 <> 0 THEN country_code END AS country_code)
            FROM usr WHERE user_id % 7 <> 3),
        bad_user AS (SELECT * FROM some_user UNION ALL
                     SELECT * FROM some_user WHERE user_id % 5 = 0),
        some_post AS (
            SELECT * REPLACE (CASE WHEN post_id % 9 <> 0 THEN post_text END AS post_text)
            FROM post WHERE post_id % 4 <> 1),
        bad_post AS (SELECT * FROM some_post UNION ALL
                     SELECT * REPLACE (CASE WHEN post_id % 9 <> 0 THEN post_text END AS post_text)
                     FROM post WHERE post_id % 6 = 0),
        bad_event AS (
            SELECT * REPLACE (CASE WHEN event_id % 17 <> 0 THEN user_id END AS user_id) FROM event
            UNION ALL SELECT * FROM event WHERE event_id % 8 = 0),
        bad_stg_events AS (SELECT * FROM bad_event), bad_fct_events AS (SELECT * FROM bad_event),
        place AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name, r_name
                  FROM nation JOIN region ON n_regionkey = r_regionkey),
        bad_dim_users AS (
            SELECT user_id, coalesce(country_code, 'Unknown') AS country_code,
                   coalesce(n_name, 'Unknown') AS country, coalesce(r_name, 'Unknown') AS region,
                   created_at, updated_at
            FROM bad_user LEFT JOIN place ON code = country_code WHERE deleted_at IS NULL),
        bad_dim_posts AS (
            SELECT p.post_id, p.user_id AS creator_id, u.country_code AS creator_country_code,
                   n_name AS creator_country, r_name AS creator_region, p.created_at,
                   p.created_at AS updated_at
            FROM bad_post p
            LEFT JOIN (SELECT * FROM usr WHERE user_id % 7 <> 3) u ON p.user_id = u.user_id
            LEFT JOIN place ON code = u.country_code WHERE p.deleted_at IS NULL)
        {counts}""",
    )


_FAULTS = _faults()


def sql() -> dict[str, str]:
    return {
        "stg_users": _with(
            "usr",
            f"""SELECT user_id, first_name, last_name,
                first_name || ' ' || last_name AS full_name, {_TIMES}, {_DELETED}, country_code,
                favorite_color AS fav_color FROM usr""",
        ),
        "stg_posts": _with(
            "post",
            f"""SELECT post_id, user_id, post_text, {_ts("created_at")} AS created_at,
                {_ts("created_at")} AS updated_at, {_DELETED} FROM post""",
        ),
        "stg_events": _STG_EVENTS,
        "fct_events": _STG_EVENTS,
        "int_users": _with(
            "usr int_user",
            f"""SELECT * EXCLUDE (created_at, updated_at, deleted_at), {_TIMES}, {_DELETED}
                FROM int_user""",
        ),
        "int_posts": _with(
            "usr post int_user int_post",
            f"""SELECT * EXCLUDE (created_at, updated_at, deleted_at), {_TIMES}, {_DELETED}
                FROM int_post""",
        ),
        "agg_post_daily": _AGG_POST,
        "agg_user_daily": _AGG_USER,
        "agg_user_daily_distinct": _AGG_USER,
        "dim_posts": _with(
            _DIMS, f"SELECT * EXCLUDE (created_at, updated_at), {_TIMES} FROM dim_post"
        ),
        "dim_users": _dim_users("", "int_user"),
        "daily_build": _dim_users("merged int_merged", "int_merged"),
        "daily_build_history": _with(
            "usr int_user merged int_merged",
            f"""
            , a AS (SELECT * FROM int_user WHERE deleted_at IS NULL),
            b AS (SELECT * FROM int_merged WHERE deleted_at IS NULL)
            SELECT user_id, country, region, is_deleted, {_INTERVAL} FROM (
                SELECT a.user_id, a.country, a.region, 'False' AS is_deleted,
                       a.updated_at AS valid_from,
                       CASE WHEN b.user_id IS NULL THEN TIMESTAMP '{SECOND_RUN}'
                            WHEN b.updated_at > a.updated_at THEN b.updated_at END AS valid_to
                FROM a LEFT JOIN b USING (user_id)
                UNION ALL
                SELECT b.user_id, b.country, b.region, 'False', b.updated_at, NULL
                FROM b LEFT JOIN a USING (user_id)
                WHERE a.user_id IS NULL OR b.updated_at > a.updated_at
                UNION ALL
                SELECT a.user_id, a.country, a.region, 'True', TIMESTAMP '{SECOND_RUN}', NULL
                FROM a ANTI JOIN b USING (user_id))""",
        ),
        "raw_user_snapshots": _with(
            "usr merged",
            f"""SELECT user_id, country_code, favorite_color, {_DELETED}, {_INTERVAL} FROM (
                SELECT u.*, u.updated_at AS valid_from, CASE WHEN m.updated_at > u.updated_at
                       THEN m.updated_at END AS valid_to
                FROM usr u JOIN merged m USING (user_id)
                UNION ALL BY NAME
                SELECT m.* EXCLUDE (applied), m.updated_at AS valid_from, NULL AS valid_to
                FROM merged m LEFT JOIN usr u USING (user_id)
                WHERE u.user_id IS NULL OR m.updated_at > u.updated_at)""",
        ),
        "scd2_history": _with(
            "feed version",
            f"""SELECT user_id, region,
                md5(CAST(user_id AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id,
                {_ts("updated_at")} AS dbt_updated_at, {_INTERVAL} FROM version""",
        ),
        "scd2_first_run": _with(
            _DIMS,
            f"""SELECT post_id, creator_id,
                md5(CAST(post_id AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id,
                {_ts("updated_at")} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to,
                true AS is_current FROM dim_post""",
        ),
        "scd2_runs": _RUNS,
        "scd2_runs_bulk": _RUNS,
        "scd2_hard_deletes": _with(
            "presence run state",
            f"""
            , step AS (SELECT *, lag(present) OVER w AS was, lag(score) OVER w AS old_score,
                       lag(updated_at) OVER w AS old_at
                       FROM state WINDOW w AS (PARTITION BY user_id ORDER BY run_ts)),
            opened AS (
                SELECT user_id, score, updated_at AS valid_from, 'False' AS is_deleted FROM step
                WHERE present AND (was IS NULL OR NOT was OR updated_at > old_at)
                UNION ALL
                SELECT user_id, old_score, run_ts, 'True' FROM step WHERE NOT present AND was)
            SELECT user_id, score, is_deleted, {_INTERVAL} FROM (
                SELECT *, lead(valid_from) OVER (
                    PARTITION BY user_id ORDER BY valid_from) AS valid_to FROM opened)""",
        ),
        "scd2_deletes_ignored": _with(
            "presence run state",
            f"""SELECT user_id, score, {_INTERVAL} FROM (
                SELECT user_id, score, updated_at AS valid_from,
                       lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to
                FROM (SELECT DISTINCT user_id, score, updated_at FROM state WHERE present))""",
        ),
        "scd2_initial_created_at": _with(
            "feed version usr",
            f"""SELECT user_id, region, {_INTERVAL} FROM (
                SELECT v.user_id, region, valid_to, CASE WHEN row_number() OVER (
                    PARTITION BY v.user_id ORDER BY valid_from) = 1
                    THEN least(valid_from, created_at) ELSE valid_from END AS valid_from
                FROM version v LEFT JOIN usr ON v.user_id = usr.user_id)""",
        ),
        "mau_by_region_month": _with("event feed version", _mau("event", "created_at")),
        "mau_bucketed": _with("event feed version", _mau("event", "created_at")),
        "mau_window_asof": _with("event feed version", _mau("event", "created_at")),
        "mau_from_daily": _with(
            "event agg_user feed version",
            _mau(
                """(SELECT user_id, CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY
                    - INTERVAL 1 MICROSECOND AS day_end FROM agg_user)""",
                "day_end",
            ),
        ),
        "active_users_by_period": _with(
            "event feed version",
            " UNION ALL ".join(
                f"""SELECT '{period}' AS period, {_day(f"date_trunc('{period}', created_at)")} AS starts,
                    region, count(DISTINCT f.user_id) AS users
                    FROM event f LEFT JOIN version v ON f.user_id = v.user_id
                        AND created_at >= valid_from AND (created_at < valid_to OR valid_to IS NULL)
                    GROUP BY ALL"""
                for period in ("month", "quarter", "year")
            ),
        ),
        "creator_asof_post": _with(
            "post feed version",
            f"""SELECT post_id, p.user_id AS creator_id, {_ts("created_at")} AS created_at, region
                FROM post p LEFT JOIN version v ON p.user_id = v.user_id
                    AND created_at >= valid_from AND (created_at < valid_to OR valid_to IS NULL)""",
        ),
        "date_spine": f"""
            SELECT {_day("d")} AS date_day, {_day("date_trunc('month', d)")} AS date_month,
                   {_day("date_trunc('quarter', d)")} AS date_quarter,
                   {_day("date_trunc('year', d)")} AS date_year,
                   CAST(extract(year FROM d) AS INTEGER) AS year,
                   CAST(extract(quarter FROM d) AS INTEGER) AS quarter,
                   CAST(extract(month FROM d) AS INTEGER) AS month,
                   strftime(d, '%B') AS month_name,
                   CAST(extract(day FROM d) AS INTEGER) AS day_of_month,
                   CAST(strftime(d, '%j') AS INTEGER) AS day_of_year,
                   CAST(CASE strftime(d, '%w') WHEN '0' THEN '7' ELSE strftime(d, '%w')
                        END AS INTEGER) AS iso_day_of_week,
                   strftime(d, '%w') IN ('0', '6') AS is_weekend
            FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)),
                         max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)""",
        "daily_gap_filled": _with(
            "event agg_user",
            f"""SELECT {_day("s.d")} AS event_date, s.user_id,
                CAST(coalesce(likes_given, 0) AS BIGINT) AS likes_given,
                CAST(coalesce(posts_viewed, 0) AS BIGINT) AS posts_viewed
                FROM (SELECT user_id, unnest(generate_series(min(event_date), max(event_date),
                          INTERVAL 1 DAY)) AS d FROM agg_user GROUP BY user_id) s
                LEFT JOIN agg_user a ON a.user_id = s.user_id AND a.event_date = s.d""",
        ),
        "like_ratio": _with(
            _DIMS,
            """SELECT post_id, likes, views,
               CASE WHEN views > 0 THEN CAST(likes AS DOUBLE) / views END AS like_ratio
               FROM dim_post""",
        ),
        "creator_like_ratio": _with(
            f"{_DIMS} creator",
            """SELECT user_id, total_likes, total_views, CASE WHEN total_views > 0
               THEN CAST(total_likes AS DOUBLE) / total_views END AS like_ratio FROM creator""",
        ),
        "active_creators": _with(
            "event agg_post post",
            f""", daily AS (SELECT event_date, user_id AS creator_id
                FROM agg_post JOIN post USING (post_id)) {_activity("daily", "creator_id")}""",
        ),
        "active_viewers": _with("event agg_user", _activity("agg_user", "user_id")),
        "viewer_sessions_batch": _with(
            "event session",
            f"""SELECT user_id, {_ts("session_start")} AS session_start,
                {_ts("session_end")} AS session_end, events FROM session""",
        ),
        "dedup_likes": _with(
            "event",
            f"""SELECT event_id, user_id, post_id, event_type, {_ts("created_at")} AS created_at
                FROM event QUALIFY is_like = 0 OR row_number() OVER (
                    PARTITION BY user_id, post_id, is_like ORDER BY created_at, event_id) = 1""",
        ),
        "post_length": """
            SELECT p_partkey AS post_id, p_name AS post_text,
                   CAST(length(p_name) AS INTEGER) AS post_length FROM part""",
        "stg_events_incremental": _STG_EVENTS,
        "agg_post_daily_incremental": _AGG_POST,
        "agg_user_daily_incremental": _AGG_USER,
        "late_and_tied_events": _with(
            "event middle",
            f""", first_run AS (
                SELECT * FROM event WHERE partition_date + CAST(
                    CASE WHEN post_id >= 70 THEN 1 ELSE 0 END AS INTEGER)
                    <= (SELECT day FROM middle))
            SELECT {_EVENT_OUT} FROM first_run
            UNION ALL
            SELECT {_EVENT_OUT} FROM event
            WHERE created_at > (SELECT max(created_at) FROM first_run)""",
        ),
        "replaced_events": _with(
            "event",
            f"""SELECT event_id, user_id, post_id, {_ts("new_time")} AS created_at, event_type,
                is_like, {_day("new_time")} AS partition_date
                FROM (SELECT *, CASE is_like WHEN 1 THEN created_at + INTERVAL 7 DAY
                      ELSE created_at END AS new_time FROM event)""",
        ),
        "raw_users_by_batches": _APPLIED_CHANGES,
        "apply_changes": _APPLIED_CHANGES,
        "audit_counts": _with(
            "usr merged",
            f"""SELECT '{INGEST_DATE}' AS ingest_date, 'user' AS table_name,
                count(*) FILTER (applied = 'inserted') AS rows_inserted,
                count(*) FILTER (applied = 'updated') AS rows_updated,
                count(*) FILTER (applied = 'deleted') AS rows_deleted
                FROM merged""",
        ),
        "live_row_summary": _with(
            "event usr post",
            """SELECT 'user' AS table_name, count(*) AS total,
                      count(*) - count(deleted_at) AS live, count(deleted_at) AS deleted FROM usr
               UNION ALL SELECT 'post', count(*), count(*) - count(deleted_at), count(deleted_at)
               FROM post
               UNION ALL SELECT 'event', count(*), count(*), CAST(0 AS BIGINT) FROM event""",
        ),
        "next_job_date": _with(
            "event", f"SELECT {_day('max(partition_date) + 1')} AS job_date FROM event"
        ),
        "random_live_sample": _with(
            "usr",
            f"""SELECT user_id, country_code FROM usr WHERE deleted_at IS NULL
                ORDER BY md5('{SAMPLE_SEED}:' || CAST(user_id AS VARCHAR)), user_id
                LIMIT {SAMPLE_ROWS}""",
        ),
        "random_posts_before": _with(
            "post",
            f"""SELECT post_id, {_ts("created_at")} AS created_at FROM post
                WHERE deleted_at IS NULL AND post.created_at < TIMESTAMP '2024-01-16'
                ORDER BY md5('{SAMPLE_SEED}:' || CAST(post_id AS VARCHAR)), post_id
                LIMIT {SAMPLE_ROWS}""",
        ),
        "dq_not_null": _with(
            "usr",
            " UNION ALL ".join(
                f"""SELECT 'not_null' AS test, '{column}' AS column_name,
                    count(*) - count({column}) AS failures FROM usr"""
                for column in ("user_id", "last_name", "deleted_at", "favorite_color")
            ),
        ),
        "dq_unique": _with(
            "post",
            """SELECT post_text, count(*) AS n_rows FROM post GROUP BY post_text
               HAVING count(*) > 1""",
        ),
        "dq_accepted_values": """
            SELECT 'accepted_values' AS test, 'event_type' AS column_name, count(*) AS failures
            FROM events WHERE event_type NOT IN ('view', 'purchase')""",
        "dq_relationships": _with(
            "event usr",
            """SELECT user_id, count(*) AS n_rows FROM event WHERE user_id NOT IN
               (SELECT user_id FROM usr WHERE deleted_at IS NULL) GROUP BY user_id""",
        ),
        "dq_suite": _suite(),
        "stream_daily_metrics": _AGG_USER,
        "stream_history": _runs(
            f"""({_DAY_OF_FEED} * 3) // (1 + (SELECT date_diff('day', min(CAST(updated_at AS DATE)),
                 max(CAST(updated_at AS DATE))) FROM feed))"""
        ),
        "stream_dedup": _with(
            "event",
            f"""SELECT event_id, user_id, post_id, {_ts("created_at")} AS created_at, event_type
                FROM event""",
        ),
        "stream_sessions": _with(
            "event session",
            f"""SELECT user_id, {_ts("session_start")} AS session_start,
                {_ts("session_end")} AS session_end, events FROM session""",
        ),
        "raw_post_snapshots": _with(
            "post",
            f"""SELECT post_id, post_text, {_INTERVAL} FROM (
                SELECT post_id, post_text, created_at AS valid_from,
                       CASE WHEN post_id % 5 = 0 THEN created_at + INTERVAL 1 DAY END AS valid_to
                FROM post
                UNION ALL
                SELECT post_id, post_text || ' (edited)', created_at + INTERVAL 1 DAY, NULL
                FROM post WHERE post_id % 5 = 0)""",
        ),
        "dim_posts_snapshots": _with(
            f"{_DIMS} middle",
            f"""
            , early AS (
                SELECT post_id, CAST(sum(likes) AS BIGINT) AS likes,
                       CAST(sum(views) AS BIGINT) AS views
                FROM agg_post WHERE event_date <= (SELECT day FROM middle) GROUP BY post_id)
            SELECT post_id, post_text, creator_region, likes, views, {_INTERVAL} FROM (
                SELECT d.post_id, post_text, creator_region, coalesce(e.likes, 0) AS likes,
                       coalesce(e.views, 0) AS views, created_at AS valid_from,
                       CASE WHEN d.post_id % 5 = 0 THEN created_at + INTERVAL 1 DAY END AS valid_to
                FROM dim_post d LEFT JOIN early e ON d.post_id = e.post_id
                UNION ALL
                SELECT post_id, post_text || ' (edited)', creator_region, likes, views,
                       created_at + INTERVAL 1 DAY, NULL
                FROM dim_post WHERE post_id % 5 = 0)""",
        ),
        "scd2_initial_runs": _with(
            "usr",
            f"""SELECT user_id, country_code,
                md5(CAST(user_id AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id,
                {_ts("least(updated_at, created_at)")} AS valid_from,
                CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM usr""",
        ),
        "agg_user_daily_lookback": _AGG_USER,
        "refreshed_events": _with(
            "event",
            f"""SELECT {_day('partition_date')} AS event_date, count(*) AS events,
                count(DISTINCT user_id) AS users,
                count(DISTINCT (user_id, post_id)) AS posts_viewed
                FROM event WHERE event_type <> 'like' GROUP BY partition_date""",
        ),
        "agg_user_daily_resent": _with(
            "event",
            f"""
            , moved AS (
                SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, post_id, is_like,
                       CAST(CASE is_like WHEN 1 THEN created_at + INTERVAL 7 DAY
                            ELSE created_at END AS DATE) AS event_date FROM event)
            SELECT {_day("event_date")} AS event_date, user_id,
                   count(DISTINCT CASE WHEN is_like = 1 THEN post_id END) AS likes_given,
                   count(DISTINCT CASE WHEN is_like = 0 THEN post_id END) AS posts_viewed
            FROM moved GROUP BY ALL""",
        ),
        "apply_tied_changes": _TIED,
        "ingestion_audit": _with(
            "event usr middle",
            f"""
            , early AS (SELECT count(*) AS n FROM event
                        WHERE partition_date <= (SELECT day FROM middle)),
            gone AS (SELECT o_custkey AS user_id FROM orders GROUP BY 1
                     HAVING arg_max(o_orderstatus, (o_orderdate, o_orderkey)) = 'F')
            SELECT '{INGEST_DATE}' AS ingest_date, 'user' AS table_name,
                   count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
                   CAST(0 AS BIGINT) AS rows_deleted FROM usr
            UNION ALL SELECT '{INGEST_DATE}', 'event', n, 0, 0 FROM early
            UNION ALL SELECT '{NEXT_DATE}', 'event', (SELECT count(*) FROM event) - n, 0, 0
            FROM early
            UNION ALL SELECT '{NEXT_DATE}', 'user', (SELECT count(*) FROM supplier),
                (SELECT count(*) FROM usr WHERE user_id NOT IN (SELECT user_id FROM gone)
                 AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')),
                (SELECT count(*) FROM usr WHERE user_id IN (SELECT user_id FROM gone))""",
        ),
        "ingestion_job_date": f"""
            SELECT strftime(DATE '{NEXT_DATE}' + 1, '%Y-%m-%d') AS job_date
            FROM (SELECT count(*) FROM events)""",
        "users_from_csv_lookup": _with(
            "usr int_user",
            f"""SELECT * EXCLUDE (created_at, updated_at, deleted_at), {_TIMES}, {_DELETED}
                FROM int_user""",
        ),
        "views_by_sql": _with(
            "event usr post int_user int_post",
            f"""SELECT {_day("partition_date")} AS partition_date, event_type, creator_region,
                count(*) AS n_events FROM event LEFT JOIN int_post USING (post_id)
                GROUP BY ALL""",
        ),
        "gap_filled_without_days": _with(
            "event agg_user",
            f"""
            , dated AS (SELECT * FROM agg_user WHERE posts_viewed <> 1)
            SELECT {_day("s.d")} AS event_date, s.user_id,
                   CAST(coalesce(likes_given, 0) AS BIGINT) AS likes_given,
                   CAST(coalesce(posts_viewed, 0) AS BIGINT) AS posts_viewed
            FROM (SELECT user_id, unnest(generate_series(min(event_date), max(event_date),
                      INTERVAL 1 DAY)) AS d FROM dated GROUP BY user_id) s
            LEFT JOIN dated a ON a.user_id = s.user_id AND a.event_date = s.d
            UNION ALL
            SELECT NULL, user_id, likes_given, posts_viewed FROM agg_user WHERE posts_viewed = 1""",
        ),
        "dedup_likes_of_unknown_users": _with(
            "event",
            """
            , known AS (SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id,
                               post_id, event_type, is_like, created_at FROM event)
            SELECT event_id, user_id, post_id, event_type FROM known
            QUALIFY is_like = 0 OR user_id IS NULL OR row_number() OVER (
                PARTITION BY user_id, post_id, is_like ORDER BY created_at, event_id) = 1""",
        ),
        "dq_suite_with_faults": _FAULTS,
    }
