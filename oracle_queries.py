"""DuckDB statements that state each registered query again, over the same tables.

They follow the definitions literally (dense label matrix, plain joins), not the
layout of the Spark plans.
"""

from rookery.functions.porter import STEP_2, STEP_3, STEP_4
from rookery.sources.sample_tables import (
    AS_OF,
    SAMPLE_CATEGORIES,
    SIGNUP_CATEGORIES,
    STOP_WORDS,
)


def _strings(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


BASE = f"""
ev AS (
  SELECT event_id AS e, user_id AS u, 'u' || user_id AS username, event_type AS t, props,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, epoch_us(ts) // 1000 AS ms,
         (epoch_us(ts) // 1000) || '-u' || user_id AS pid
  FROM events),
sizes AS (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(DISTINCT user_id) FROM events) AS n),
evx AS (
  SELECT ev.*, 'doc://' || ((e * 7 + k) % d) AS link, 'u' || ((u + 1 + k) % n) AS friend,
         'u' || ((u + k) % n) AS wall, 'u' || ((u + 1) % n) AS nextuser
  FROM ev, sizes),
all_articles AS (
  SELECT lang AS author, upper(source) AS category, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS date,
         text AS headline, 'doc://' || doc_id AS link, text AS description
  FROM documents),
articles AS (SELECT * FROM all_articles WHERE date <= DATE '{AS_OF}'),
interests AS (SELECT DISTINCT username, 'SRC' || (k % 20) AS category FROM ev WHERE t = 'signup'),
likes AS (SELECT DISTINCT username, link FROM evx WHERE t = 'purchase'),
seen AS (SELECT DISTINCT username, link FROM evx WHERE t = 'view'),
friend_log AS (
  SELECT username AS a, friend AS b, CASE WHEN t = 'click' THEN 'add' ELSE 'remove' END AS action, ms, e
  FROM evx WHERE t IN ('click', 'error') AND username <> friend),
friend_both AS (
  SELECT a, b, action, ms, e FROM friend_log UNION ALL SELECT b, a, action, ms, e FROM friend_log),
friends AS (SELECT a AS username1, b AS username2, max(ms) AS timestamp FROM friend_both WHERE action = 'add' GROUP BY a, b),
users AS (
  SELECT username, 'First' || u AS firstname, 'Last' || (u % 7) AS lastname, 'aff' || (u % 5) AS affiliation,
         (u % 12 + 1) || '/' || (u % 28 + 1) || '/1990' AS birthday, arg_max(t <> 'error', (ms, e)) AS loggedin
  FROM ev GROUP BY u, username),
catalog AS (
  SELECT link, a.headline AS headline, a.category AS category, strftime(a.date, '%Y-%m-%d') AS date,
         a.author AS author, a.description AS description, CAST(0 AS BIGINT) AS likes
  FROM (SELECT link, min({{'headline': headline, 'category': category, 'author': author, 'date': date,
                          'description': description}}) AS a FROM all_articles GROUP BY link)),
posts AS (SELECT username AS poster, pid, ms, props AS content, wall FROM evx WHERE t = 'view'),
wallposts AS (
  SELECT poster AS posterusername, pid AS postuniqueid, ms AS timestamp, content, wall AS wallusername, false AS flipped
  FROM posts WHERE poster <> wall
  UNION ALL
  SELECT wall, pid, ms, content, poster, true FROM posts),
statusposts AS (
  SELECT username AS posterusername, pid AS postuniqueid, ms AS timestamp, props AS content FROM ev WHERE t = 'signup'),
comments AS (
  SELECT c.username AS usernameofcommentor, p.pid AS postuniqueid, c.ms AS timestamp, c.props AS content
  FROM ev c JOIN ev p ON p.e = c.e - c.e % 10 AND p.t = 'signup' WHERE c.t = 'error'),
visits AS (
  SELECT username AS viewer, username AS owner FROM users
  UNION SELECT poster, wall FROM posts
  UNION SELECT username, nextuser FROM evx),
messages AS (SELECT conv_id AS room, turn, role AS sender, text AS content FROM conversations),
membership AS (SELECT DISTINCT conv_id AS room, role AS member FROM conversations),
room_log AS (
  SELECT k AS room, username AS member, CASE WHEN t = 'view' THEN 'join' ELSE 'leave' END AS action, ms, e
  FROM ev WHERE t IN ('view', 'error')),
user_rooms AS (
  SELECT room, member FROM (SELECT room, member, arg_max(action, (ms, e)) AS action FROM room_log GROUP BY room, member)
  WHERE action = 'join'),
index_words AS (
  SELECT DISTINCT w AS keyword, link FROM (
    SELECT link, unnest(string_split(lower(regexp_replace(headline, '[[:punct:]]', '', 'g')), ' ')) AS w FROM all_articles)
  WHERE regexp_matches(w, '^\\p{{L}}+$') AND w NOT IN ({_strings(STOP_WORDS)})),
queries AS (
  SELECT u AS query_id, username, text
  FROM (SELECT DISTINCT u, username FROM ev WHERE u % 100 = 0), sizes JOIN documents ON doc_id = u % d)
"""

GRAPH = """
listed AS (SELECT category, link, count(*) AS copies FROM {articles} GROUP BY category, link),
arcs AS (
  SELECT 'user' AS st, username1 AS s, 'user' AS dt, username2 AS d, 1 AS copies FROM friends
    WHERE username1 IN (SELECT username FROM users)
  UNION ALL SELECT 'user', username, 'category', category, 1 FROM interests
  UNION ALL SELECT 'user', username, 'article', link, 1 FROM likes
  UNION ALL SELECT 'category', category, 'user', username, 1 FROM interests
  UNION ALL SELECT 'category', category, 'article', link, copies FROM listed
  UNION ALL SELECT 'article', link, 'user', username, 1 FROM likes
  UNION ALL SELECT 'article', link, 'category', category, 1 FROM listed),
degrees AS (
  SELECT node_type, node, CAST(sum(CASE WHEN dt = 'user' THEN copies ELSE 0 END) AS BIGINT) AS n_user,
         CAST(sum(CASE WHEN dt = 'category' THEN copies ELSE 0 END) AS BIGINT) AS n_category,
         CAST(sum(CASE WHEN dt = 'article' THEN copies ELSE 0 END) AS BIGINT) AS n_article
  FROM (SELECT st AS node_type, s AS node, dt, copies FROM arcs
        UNION ALL SELECT 'user', username, NULL, 0 FROM users)
  GROUP BY node_type, node),
weights AS (
  SELECT node_type, node,
    CASE WHEN node_type = 'user' THEN CASE
           WHEN n_user = 0 THEN 0.0::DOUBLE
           WHEN n_category = 0 AND n_article = 0 THEN 1.0::DOUBLE / n_user
           WHEN n_article = 0 THEN 0.3::DOUBLE / 0.6::DOUBLE / n_user
           WHEN n_category = 0 THEN 0.3::DOUBLE / 0.7::DOUBLE / n_user
           ELSE 0.3::DOUBLE / n_user END
         WHEN node_type = 'category' THEN CASE WHEN n_user = 0 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE / n_user END
         ELSE 1.0::DOUBLE / (n_user + n_category) END AS w_user,
    CASE WHEN node_type = 'user' THEN CASE
           WHEN n_category = 0 THEN 0.0::DOUBLE
           WHEN n_user = 0 AND n_article = 0 THEN 1.0::DOUBLE / n_category
           WHEN n_article = 0 THEN 0.3::DOUBLE / 0.6::DOUBLE / n_category
           WHEN n_user = 0 THEN 0.3::DOUBLE / 0.7::DOUBLE / n_category
           ELSE 0.3::DOUBLE / n_category END
         WHEN node_type = 'category' THEN 0.0::DOUBLE
         ELSE 1.0::DOUBLE / (n_user + n_category) END AS w_category,
    CASE WHEN node_type = 'user' THEN CASE
           WHEN n_article = 0 THEN 0.0::DOUBLE
           WHEN n_user = 0 AND n_category = 0 THEN 1.0::DOUBLE / n_article
           WHEN n_user = 0 OR n_category = 0 THEN 0.4::DOUBLE / 0.7::DOUBLE / n_article
           ELSE 0.4::DOUBLE / n_article END
         WHEN node_type = 'category' THEN CASE WHEN n_user = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END / n_article
         ELSE 0.0::DOUBLE END AS w_article
  FROM degrees WHERE node_type <> 'category' OR n_article > 0),
edges AS MATERIALIZED (
  SELECT st, s, dt, d, CASE dt WHEN 'user' THEN w_user WHEN 'category' THEN w_category ELSE w_article END AS w
  FROM arcs JOIN weights ON st = node_type AND s = node)
"""

START = """
nodes AS (
  SELECT 'user' AS t, username AS n FROM users
  UNION SELECT 'category', category FROM interests UNION SELECT 'category', category FROM listed
  UNION SELECT 'article', link FROM likes UNION SELECT 'article', link FROM listed),
lab0 AS MATERIALIZED (
  SELECT t, n, username AS u, CASE WHEN t = 'user' AND n = username THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS w
  FROM nodes, users),
end0 AS (SELECT false AS done)
"""

ROUND = """
sum{i} AS MATERIALIZED (
  SELECT e.dt AS t, e.d AS n, l.u, sum(e.w * l.w) AS w
  FROM edges e JOIN lab{p} l ON l.t = e.st AND l.n = e.s
  JOIN (SELECT DISTINCT t, n FROM lab{p}) a ON a.t = e.dt AND a.n = e.d
  WHERE NOT (SELECT done FROM end{p}) GROUP BY e.dt, e.d, l.u),
own{i} AS (SELECT t, n, u, CASE WHEN t = 'user' AND n = u AND w < 1 THEN 1.0::DOUBLE ELSE w END AS w FROM sum{i}),
tot{i} AS (SELECT t, n, sum(w) AS total FROM own{i} GROUP BY t, n),
lab{i} AS MATERIALIZED (
  SELECT t, n, u, CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE w / total END AS w FROM own{i} JOIN tot{i} USING (t, n)
  UNION ALL SELECT t, n, u, w FROM lab{p} WHERE (SELECT done FROM end{p})),
end{i} AS MATERIALIZED ({stop})
"""

STOP = """
  SELECT (SELECT done FROM end{p}) OR count(*) = 0 AS done
  FROM lab{p} a JOIN lab{i} b USING (t, n, u) WHERE abs(a.w - b.w) > 0.05"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + " "


def _rounds(n: int, stop: bool, articles: str = "articles") -> list[str]:
    parts = [BASE, GRAPH.format(articles=articles), START]
    for i in range(1, n + 1):
        rule = STOP.format(i=i, p=i - 1) if stop else "SELECT false AS done"
        parts.append(ROUND.format(i=i, p=i - 1, stop=rule))
    return parts


def _scores(last: int, articles: str = "articles", threshold: float = 0.01) -> str:
    """The scores CTE over the labels of one round."""
    return f"""
scores AS (
  SELECT l.u AS username, l.n AS link, a.author, a.category, strftime(a.date, '%Y-%m-%d') AS date, l.w AS weight
  FROM lab{last} l JOIN (
    SELECT link, min({{'headline': headline, 'category': category, 'author': author, 'date': date,
                     'description': description}}) AS a FROM {articles} WHERE date <= DATE '{AS_OF}' GROUP BY link) x
    ON l.t = 'article' AND l.n = x.link
  WHERE l.w > {threshold})"""


RECS = f"""
recs AS (
  SELECT * FROM scores s WHERE date = '{AS_OF}'
    AND NOT EXISTS (SELECT 1 FROM seen x WHERE x.username = s.username AND x.link = s.link)
    AND CAST('0x' || substr(md5(s.username || '|' || s.link || '|0'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE <= weight)"""

SCORE_COLUMNS = "username, link, author, category, date, round(weight, 6) AS weight"


def _ranked(tail: str, *more: str) -> str:
    return _with(*_rounds(15, True), _scores(15), *more) + tail


def _plain(tail: str, *more: str) -> str:
    return _with(BASE, *more) + tail


def _graph(tail: str) -> str:
    return _with(BASE, GRAPH.format(articles="articles")) + tail


def _measure(shape: str) -> str:
    return f"len(regexp_extract_all({shape}, 'v+c+'))"


def _head(column: str, cut: int) -> str:
    return f"left({column}, -{cut})"


def _by_ending(rules: dict[str, str], least: int, cut: int | None = None) -> str:
    """Replace the longest listed ending when what is left has more than ``least`` measures."""
    cases = []
    for ending in sorted(rules, key=len, reverse=True):
        n = len(ending) if cut is None else min(cut, len(ending))
        cases.append(
            f"WHEN ends_with(w, '{ending}') THEN CASE WHEN {_measure(_head('s', n))} > {least} "
            f"THEN {_head('w', n)} || '{rules[ending]}' ELSE w END"
        )
    return "CASE " + " ".join(cases) + " ELSE w END"


# one letter per character: a vowel, or a consonant; y is a vowel after a consonant
_SHAPE = """list_reduce(list_prepend('', string_split(w, '')), lambda t, ch: t || CASE
    WHEN ch IN ('a', 'e', 'i', 'o', 'u') OR (ch = 'y' AND ends_with(t, 'c')) THEN 'v' ELSE 'c' END)"""
_SHORT = "ends_with({s}, 'cvc') AND right({w}, 1) NOT IN ('w', 'x', 'y')"

STEM_STEPS = (
    """CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, -2)
       WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN left(w, -1) ELSE w END""",
    # the marks say what is still to be done: 1 for a stripped past form
    f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure("left(s, -3)")} > 0 THEN left(w, -1) ELSE w END
       WHEN ends_with(w, 'ed') AND contains(left(s, -2), 'v') THEN left(w, -2) || '1'
       WHEN ends_with(w, 'ing') AND contains(left(s, -3), 'v') THEN left(w, -3) || '1' ELSE w END""",
    f"""CASE WHEN NOT ends_with(w, '1') THEN w
       WHEN ends_with(w, 'at1') OR ends_with(w, 'bl1') OR ends_with(w, 'iz1') THEN left(w, -1) || 'e'
       WHEN length(w) > 2 AND w[-2:-2] = w[-3:-3] AND ends_with(left(s, -1), 'c')
         THEN CASE WHEN w[-2:-2] NOT IN ('l', 's', 'z') THEN left(w, -2) ELSE CASE
           WHEN {_measure("left(s, -1)")} = 1 AND {_SHORT.format(s="left(s, -1)", w="left(w, -1)")} THEN left(w, -1) || 'e' ELSE left(w, -1) END END
       WHEN {_measure("left(s, -1)")} = 1 AND {_SHORT.format(s="left(s, -1)", w="left(w, -1)")} THEN left(w, -1) || 'e'
       ELSE left(w, -1) END""",
    "CASE WHEN ends_with(w, 'y') AND contains(left(s, -1), 'v') THEN left(w, -1) || 'i' ELSE w END",
    _by_ending(STEP_2, 0),
    _by_ending(STEP_3, 0),
    "CASE "
    + " ".join(
        f"WHEN ends_with(w, '{e}') THEN CASE WHEN {_measure(_head('s', n))} > 1 THEN {_head('w', n)} ELSE w END"
        for e in sorted(STEP_4, key=len, reverse=True)
        for n in [3 if e in ("sion", "tion") else len(e)]
    )
    + " ELSE w END",
    f"""CASE WHEN ends_with(w, 'e') AND ({_measure("left(s, -1)")} > 1 OR ({_measure("left(s, -1)")} = 1
         AND NOT ({_SHORT.format(s="left(s, -1)", w="left(w, -1)")}))) THEN left(w, -1) ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {_measure('s')} > 1 THEN left(w, -1) ELSE w END",
)


def _stems() -> list[str]:
    """CTEs that end in stems(word, stem) for all words of the index and the queries."""
    parts = [
        """vocabulary AS (SELECT keyword AS word FROM index_words
           UNION SELECT unnest(string_split(lower(text), ' ')) FROM queries)""",
        f"stem0 AS (SELECT word, w, {_SHAPE} AS s FROM (SELECT word, word AS w FROM vocabulary WHERE length(word) > 2))",
    ]
    for k, step in enumerate(STEM_STEPS, 1):
        parts.append(f"stem{k} AS (SELECT word, w, {_SHAPE} AS s FROM (SELECT word, {step} AS w FROM stem{k - 1}))")
    last = len(STEM_STEPS)
    parts.append(f"stems AS (SELECT word, w AS stem FROM stem{last} UNION ALL SELECT word, word FROM vocabulary WHERE length(word) < 3)")
    parts.append("stemmed_words AS (SELECT DISTINCT stem AS keyword, link FROM index_words JOIN stems ON word = keyword)")
    return parts


def _searched(index: str, stem: str) -> str:
    """Ranked hits of all queries over an index table; ``stem`` maps a query word."""
    return _ranked(
        """SELECT h.*, c.headline, c.author, c.date, c.description, c.category, coalesce(b.likes, 0) AS likes
           FROM placed h LEFT JOIN catalog c ON c.link = h.link LEFT JOIN balance b ON b.link = h.link""",
        LIKE_BALANCE,
        *_stems(),
        f"""
hits AS (
  SELECT query_id, username, link, count(*) AS keyword_count
  FROM (SELECT query_id, username, {stem} AS keyword
        FROM (SELECT query_id, username, unnest(string_split(lower(text), ' ')) AS asked FROM queries) LEFT JOIN stems ON word = asked) q
  JOIN {index} USING (keyword) GROUP BY query_id, username, link),
placed AS (
  SELECT query_id, username, link, keyword_count, round(coalesce(weight, 0), 6) AS weight,
    row_number() OVER (PARTITION BY query_id ORDER BY keyword_count DESC, round(coalesce(weight, 0), 9) DESC, link) AS position
  FROM hits LEFT JOIN scores USING (username, link))""",
    )


CHANGES = f"""
asked AS (
  SELECT username, CASE WHEN t = 'click' THEN 'add' ELSE 'delete' END AS action, 'SRC' || (k % 25) AS category, ms, e,
         row_number() OVER (PARTITION BY username ORDER BY ms, e) AS i
  FROM ev WHERE t IN ('click', 'error')),
fold AS (
  SELECT username, CAST(0 AS BIGINT) AS i, NULL::VARCHAR AS action, NULL::VARCHAR AS category, NULL::BIGINT AS ms,
         NULL::BIGINT AS e, NULL::VARCHAR AS outcome,
         coalesce((SELECT list(category) FROM interests x WHERE x.username = users.username), []::VARCHAR[]) AS held
  FROM users
  UNION ALL
  SELECT f.username, a.i, a.action, a.category, a.ms, a.e,
    CASE WHEN a.action = 'add' THEN CASE
           WHEN list_contains(held, a.category) THEN 'already_interested'
           WHEN a.category NOT IN ({_strings(SAMPLE_CATEGORIES)}) THEN 'invalid_category' ELSE 'accepted' END
         WHEN len(held) < 3 THEN 'too_few'
         WHEN NOT list_contains(held, a.category) THEN 'not_interested' ELSE 'accepted' END,
    CASE WHEN a.action = 'add' AND NOT list_contains(held, a.category) AND a.category IN ({_strings(SAMPLE_CATEGORIES)})
           THEN list_append(held, a.category)
         WHEN a.action = 'delete' AND len(held) >= 3 THEN list_filter(held, lambda h: h <> a.category)
         ELSE held END
  FROM fold f JOIN asked a ON a.username = f.username AND a.i = f.i + 1)
"""

SIGNUPS = f"""
signups AS (
  SELECT CASE WHEN c_custkey % 25 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN 'shared' || (c_custkey % 100) ELSE c_name END AS username,
         CASE WHEN c_custkey % 31 = 0 THEN '' ELSE c_name END AS password,
         'customer' AS firstname, 'no' || c_custkey AS lastname,
         CASE WHEN c_acctbal < 0 THEN '' ELSE c_name || '@mail' END AS email,
         'nation' || c_nationkey AS affiliation, '1/1/1990' AS birthday, c_mktsegment AS i1,
         CASE c_custkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'AUTOMOBILE' END AS i2, c_custkey AS seq
  FROM customer),
taken AS (SELECT 'Customer#' || lpad(CAST(s_suppkey * 10 + 2 AS VARCHAR), 9, '0') AS username FROM supplier),
checked AS (
  SELECT *, CASE
      WHEN upper(i1) NOT IN ({_strings(SIGNUP_CATEGORIES)}) THEN 'invalidnewsinterest1'
      WHEN i2 NOT IN ({_strings(SIGNUP_CATEGORIES)}) THEN 'invalidnewsinterest2'
      WHEN upper(i1) = i2 THEN 'bothnewsinterestsaresame'
      WHEN username = '' THEN 'usernameIsBlank' WHEN password = '' THEN 'passwordIsBlank'
      WHEN email = '' THEN 'emailaddressIsBlank' END AS failed
  FROM signups),
validated AS (
  SELECT *, CASE WHEN failed IS NOT NULL THEN failed
      WHEN username IN (SELECT username FROM taken)
        OR row_number() OVER (PARTITION BY username, failed IS NULL ORDER BY seq) > 1 THEN 'usernameAlreadyTaken' END AS reason
  FROM checked)
"""

LAST_PROFILE = """
profile_log AS (
  SELECT username, ms, e, CASE t WHEN 'view' THEN 'affiliation' WHEN 'click' THEN 'email' ELSE 'password' END AS field,
         CASE t WHEN 'view' THEN 'aff' || (k % 5) WHEN 'click' THEN username || '@mail' || k ELSE sha256('secret' || k) END AS value
  FROM ev WHERE t IN ('view', 'click', 'purchase'))
"""

LIKE_BALANCE = """
balance AS (
  SELECT link, CAST(sum(CASE WHEN t = 'purchase' THEN 1 ELSE -1 END) AS BIGINT) AS likes
  FROM evx WHERE t IN ('purchase', 'error') GROUP BY link)
"""

PRESENCE = "SELECT username, arg_max(t <> 'error', (ms, e)) AS loggedin FROM ev GROUP BY username"
POST = "posterusername, postuniqueid, p.timestamp, content, wallusername, flipped"
MESSAGES = "SELECT room AS roomuniqueid, turn AS timestamp, sender, content FROM messages"
DELIVERIES = """SELECT m.room AS roomuniqueid, turn AS timestamp, sender, member AS receiver, content
  FROM messages m JOIN membership p ON m.room = p.room WHERE member <> sender"""
LABELS = "SELECT t AS node_type, n AS node, u AS label, round(w, 6) AS weight FROM lab{i} WHERE w > 0.01"


POST_TIES = "postuniqueid, posterusername, content, wallusername, flipped"
STATUS_TIES = "postuniqueid, posterusername, content"


def _placed(rows: str, reader: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY {reader} ORDER BY {order}) AS position FROM ({rows})"


STREAM_FORMS = {
    "stream_interest_changes": "interest_changes",
    "stream_signups": "validate_signups",
    "stream_affiliations": "affiliation_events",
    "stream_profile": "current_profile",
    "stream_membership": "current_membership",
}


def oracle_sql() -> dict[str, str]:
    sql = {
        # sources and sinks
        "users_scan": _plain(
            """SELECT username, firstname, lastname, affiliation, birthday, loggedin, coalesce(i.interests, '') AS interests FROM users
            LEFT JOIN (SELECT username, string_agg(category, ',' ORDER BY category) AS interests FROM interests GROUP BY username) i USING (username)"""
        ),
        "friends_scan": _plain("SELECT username1, timestamp, username2 FROM friends"),
        "stopword_scan": "SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS word FROM documents",
        "article_scan": _plain(
            "SELECT author, category, strftime(date + INTERVAL 48 MONTH, '%Y-%m-%d') AS date, headline, link, description FROM all_articles"
        ),
        "article_catalog": _plain("SELECT * FROM catalog"),
        "user_lookup": _plain(
            "SELECT username, firstname, lastname FROM users WHERE username IN (SELECT username2 FROM friends)"
        ),
        "seen_snapshot": _plain(
            "SELECT username, link FROM seen"
        ),
        # filters
        "published_today": _plain(
            f"SELECT author, category, strftime(date, '%Y-%m-%d') AS date, headline, link, description FROM all_articles WHERE date = DATE '{AS_OF}'"
        ),
        "interest_pairs": _plain("SELECT username, category FROM interests"),
        "category_article_pairs": _plain("SELECT category, link FROM all_articles"),
        "whitelisted_interests": _plain(
            f"SELECT username, category, category IN ({_strings(SAMPLE_CATEGORIES[:10])}) AS allowed FROM interests"
        ),
        "valid_queries": """
            SELECT doc_id AS query_id, CAST(doc_id AS VARCHAR) AS username,
                   length(text) > 0 AND len(list_filter(string_split(lower(text), ''), lambda c: c <> ' ' AND c = upper(c))) = 0 AS valid
            FROM documents""",
        # graph and ranking
        "degree_counts": _graph("SELECT * FROM degrees"),
        "edge_weights": _graph(
            "SELECT node_type, node, round(w_user, 6) AS w_user, round(w_category, 6) AS w_category, round(w_article, 6) AS w_article FROM weights"
        ),
        "edge_list": _graph("SELECT st AS src_type, s AS src, dt AS dst_type, d AS dst, round(w, 6) AS w FROM edges"),
        "initial_labels": _plain(
            "SELECT 'user' AS node_type, username AS node, username AS label, 1.0::DOUBLE AS weight FROM users"
        ),
        "adsorption_2": _with(*_rounds(2, False)) + LABELS.format(i=2),
        "adsorption_3": _with(*_rounds(3, False)) + LABELS.format(i=3),
        "adsorption_converged": _with(*_rounds(15, True)) + LABELS.format(i=15),
        "article_scores": _ranked(f"SELECT {SCORE_COLUMNS} FROM scores"),
        "article_scores_unfiltered": _with(
            *_rounds(15, True, "all_articles"), _scores(15, "all_articles")
        )
        + f"SELECT {SCORE_COLUMNS} FROM scores",
        "recommendations": _ranked(f"SELECT {SCORE_COLUMNS} FROM recs", RECS),
        "seen_update": _ranked("SELECT username, link FROM seen UNION SELECT username, link FROM recs", RECS),
        "unseen_scores": _ranked(
            f"SELECT {SCORE_COLUMNS} FROM scores s WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.username = s.username AND x.link = s.link)"
        ),
        "recommendation_page": _ranked(
            """SELECT r.username, r.link, r.author, r.category, r.date, c.headline, c.description, round(weight, 6) AS weight,
                coalesce(b.likes, 0) AS likes FROM recs r LEFT JOIN catalog c USING (link) LEFT JOIN balance b USING (link)""",
            RECS,
            LIKE_BALANCE,
        ),
        "scheduled_refresh": _ranked(f"SELECT {SCORE_COLUMNS} FROM recs", RECS),
        "stored_scores": _ranked(f"SELECT {SCORE_COLUMNS} FROM scores"),
        "stored_recommendations": _ranked(f"SELECT {SCORE_COLUMNS} FROM recs", RECS),
        "refresh_on_changes": _ranked(f"SELECT {SCORE_COLUMNS} FROM recs", RECS),
        "chunked_sink": _plain("SELECT username, link FROM seen"),
        # text and search
        "keyword_index": _plain("SELECT * FROM index_words"),
        "stored_keyword_index": _plain("SELECT * FROM index_words"),
        "query_words": _plain(
            """SELECT query_id, username, CAST(pos AS BIGINT) - 1 AS pos, keyword FROM (
                 SELECT query_id, username, generate_subscripts(words, 1) AS pos, unnest(words) AS keyword
                 FROM (SELECT query_id, username, string_split(lower(text), ' ') AS words FROM queries))"""
        ),
        "keyword_index_stemmed": _with(BASE, *_stems()) + "SELECT * FROM stemmed_words",
        "search_ranked": _searched("index_words", "asked"),
        "search_ranked_stemmed": _searched("stemmed_words", "stem"),
        "like_counts": _plain(
            "SELECT c.* REPLACE (coalesce(b.likes, 0) AS likes) FROM catalog c LEFT JOIN balance b USING (link)", LIKE_BALANCE
        ),
        "liked_articles": _plain("SELECT username, c.* FROM likes JOIN catalog c USING (link)"),
        # feeds
        "home_feed": _plain(
            _placed(
                f"""SELECT username1 AS username, {POST} FROM friends f JOIN wallposts p ON posterusername = username2 AND wallusername = username2
                UNION ALL
                SELECT posterusername, {POST} FROM wallposts p JOIN friends f ON posterusername = username1 AND wallusername = username2
                WHERE wallusername <> posterusername""",
                "username",
                f"timestamp DESC, {POST_TIES}",
            )
        ),
        "wall_feed": _plain(
            _placed(
                f"""SELECT viewer, owner, {POST} FROM visits v JOIN wallposts p ON v.owner = p.posterusername
                WHERE (viewer = owner OR EXISTS (SELECT 1 FROM friends WHERE username1 = viewer AND username2 = owner))
                  AND (wallusername = owner OR (flipped AND EXISTS (
                        SELECT 1 FROM friends WHERE username1 = owner AND username2 = wallusername)))""",
                "viewer, owner",
                f"timestamp DESC, {POST_TIES}",
            )
        ),
        "status_feed": _plain(
            _placed(
                "SELECT username1 AS username, posterusername, postuniqueid, p.timestamp, content FROM friends f JOIN statusposts p ON posterusername = username2",
                "username",
                f"timestamp, {STATUS_TIES}",
            )
        ),
        "own_status": _plain(_placed("SELECT * FROM statusposts", "posterusername", f"timestamp DESC, {STATUS_TIES}")),
        "comment_threads": _plain(
            _placed(
                """SELECT postuniqueid, timestamp, usernameofcommentor, min(content) AS content FROM comments
                WHERE postuniqueid IN (SELECT postuniqueid FROM statusposts) GROUP BY postuniqueid, timestamp, usernameofcommentor""",
                "postuniqueid",
                "timestamp DESC, usernameofcommentor",
            )
        ),
        "post_times": _plain(
            """SELECT postuniqueid, strftime(make_timestamp((timestamp // 1000) * 1000000) - INTERVAL 5 HOUR, '%-m/%-d/%Y, %-I:%M:%S %p') AS shown
            FROM statusposts"""
        ),
        # people
        "online_friends": _plain(
            "SELECT username1 AS username, username2 AS friend FROM friends JOIN users ON username = username2 WHERE loggedin"
        ),
        "friend_status": _plain(
            """SELECT username1 AS username, username2 AS friend, CASE WHEN coalesce(loggedin, false) THEN 'online' ELSE 'offline' END AS status
            FROM friends LEFT JOIN users ON username = username2"""
        ),
        "recent_friendships": _plain(
            f"""SELECT username1 AS username, username2 AS friend, timestamp FROM friends
            WHERE epoch_ms(TIMESTAMP '{AS_OF} 00:00:00') - timestamp < 86400000"""
        ),
        "friend_visits": _plain(
            "SELECT viewer AS username, owner AS friend FROM visits JOIN friends ON viewer = username1 AND owner = username2"
        ),
        "visible_walls": _plain(
            "SELECT viewer, owner FROM visits WHERE viewer = owner OR (viewer, owner) IN (SELECT (username1, username2) FROM friends)"
        ),
        "affiliated_friends": _plain(
            """SELECT viewer, owner, username2 AS friend, me.affiliation FROM visits
            JOIN users me ON me.username = viewer JOIN friends ON username1 = owner
            JOIN users f ON f.username = username2 AND f.affiliation = me.affiliation"""
        ),
        "ego_network": _plain(
            "SELECT username AS id, username AS name, username2 AS child_id, username2 AS child_name FROM users LEFT JOIN friends ON username1 = username"
        ),
        "user_details": _plain(
            """SELECT username, firstname, lastname, birthday, affiliation, coalesce(i.interests, '') AS interests FROM users
            LEFT JOIN (SELECT username, string_agg(category, ',' ORDER BY category) AS interests FROM interests GROUP BY username) i USING (username)"""
        ),
        "suggest_users": _plain(
            """SELECT term, CAST(position AS BIGINT) AS position, username, fullname FROM (
                 SELECT term, username, fullname, row_number() OVER (PARTITION BY term ORDER BY username) AS position
                 FROM (SELECT lower(firstname) AS term FROM users) q
                 JOIN (SELECT username, firstname || ' ' || lastname AS fullname FROM users) s
                   ON contains(fullname, upper(substr(term, 1, 1)) || substr(term, 2)))
               WHERE position <= 5"""
        ),
        # chat
        "rooms_by_user": _plain(
            """SELECT m.member AS username, m.room AS roomuniqueid, n AS n_members FROM user_rooms m
            JOIN (SELECT room, count(*) AS n FROM user_rooms GROUP BY room) USING (room)"""
        ),
        "room_rosters": _plain(
            """SELECT room AS roomuniqueid, member FROM user_rooms
            WHERE room IN (SELECT room FROM user_rooms WHERE member IN (SELECT username FROM users WHERE loggedin))"""
        ),
        "participants": _plain("SELECT room AS roomuniqueid, member FROM membership"),
        "find_room": _plain(
            """SELECT group_id, member_key, roomuniqueid FROM (
                 SELECT room AS group_id, string_agg(member, '__' ORDER BY member) AS member_key FROM (
                   SELECT room, member FROM membership WHERE room % 100 = 0
                   UNION ALL SELECT DISTINCT room, 'nobody' FROM membership WHERE room % 300 = 0) GROUP BY room) g
               LEFT JOIN (SELECT key, min(room) AS roomuniqueid FROM (
                 SELECT room, string_agg(member, '__' ORDER BY member) AS key FROM membership GROUP BY room) GROUP BY key) r
               ON g.member_key = r.key"""
        ),
        "chat_history": _plain(_placed(MESSAGES, "roomuniqueid", "timestamp, sender, content")),
        "direct_history": _plain(
            _placed(
                """SELECT least(username, friend) || '__' || greatest(username, friend) AS conversation, ms AS timestamp,
                     username AS fromuser, friend AS touser, props AS message FROM evx WHERE t = 'click'""",
                "conversation",
                "timestamp, fromuser, message",
            )
        ),
        "invitable_users": _plain(
            """SELECT m.room AS roomuniqueid, m.member AS username, username2 AS friend FROM user_rooms m JOIN friends ON username1 = m.member
            WHERE NOT EXISTS (SELECT 1 FROM user_rooms x WHERE x.room = m.room AND x.member = username2)"""
        ),
        "message_deliveries": _plain(DELIVERIES),
        # change logs
        "current_friends": _plain(
            """SELECT a AS username1, ms AS timestamp, b AS username2 FROM (
                 SELECT a, b, arg_max(action, (ms, e)) AS action, arg_max(ms, (ms, e)) AS ms FROM friend_both GROUP BY a, b)
               WHERE action = 'add'"""
        ),
        "mirror_wallposts": _plain("SELECT * FROM wallposts"),
        "current_likes": _plain(
            """SELECT username, link FROM (
                 SELECT username, link, arg_max(t, (ms, e)) AS t FROM evx WHERE t IN ('purchase', 'error') GROUP BY username, link)
               WHERE t = 'purchase'"""
        ),
        "interest_changes": "WITH RECURSIVE " + ",".join([BASE, CHANGES])
        + " SELECT username, ms AS timestamp, e AS seq, action, category, outcome FROM fold WHERE i > 0",
        "interest_posts": "WITH RECURSIVE " + ",".join([BASE, CHANGES])
        + """ SELECT username AS posterusername, ms || '-' || username AS postuniqueid, ms AS timestamp,
                CASE action WHEN 'add' THEN 'Added news interest: ' ELSE 'Delete news interest: ' END || category AS content
              FROM fold WHERE outcome = 'accepted'""",
        "affiliation_events": _plain(
            """SELECT username AS posterusername, ms || '-' || username AS postuniqueid, ms AS timestamp, 'Changed affiliation to ' || affiliation AS content
               FROM (SELECT username, ms, 'aff' || (k % 5) AS affiliation,
                       lag('aff' || (k % 5), 1, 'aff' || (u % 5)) OVER (PARTITION BY username ORDER BY ms, e) AS before
                     FROM ev WHERE t = 'view')
               WHERE affiliation <> before"""
        ),
        "current_profile": _plain(
            """SELECT username, arg_max(value, (ms, e)) FILTER (field = 'affiliation') AS affiliation,
                 arg_max(value, (ms, e)) FILTER (field = 'email') AS email,
                 arg_max(value, (ms, e)) FILTER (field = 'password') AS password FROM profile_log GROUP BY username""",
            LAST_PROFILE,
        ),
        "presence": _plain(PRESENCE),
        "validate_signups": _with(SIGNUPS.lstrip())
        + "SELECT seq, username, reason FROM validated",
        "new_accounts": _with(SIGNUPS.lstrip())
        + """SELECT username, sha256(password) AS password, 'Customer' AS firstname, 'No' || substr(lastname, 3) AS lastname, email,
               affiliation, birthday, upper(i1) || ',' || i2 AS interests, 'Customer No' || substr(lastname, 3) AS fullname
             FROM validated WHERE reason IS NULL""",
        "current_membership": _plain("SELECT room AS roomuniqueid, member FROM user_rooms"),
        "latest_messages": _plain(
            """SELECT room AS roomuniqueid, timestamp, m.sender AS sender, m.content AS content FROM (
                 SELECT room, turn AS timestamp, max({'sender': sender, 'content': content}) AS m FROM messages GROUP BY room, turn)"""
        ),
        # streams
        "stream_messages": _plain(MESSAGES),
        "stream_likes": _plain("SELECT * FROM balance", LIKE_BALANCE),
        "stream_presence": _plain(PRESENCE),
        "stream_friends": _plain(
            "SELECT a AS username1, b AS username2, arg_max(action, (ms, e)) AS action FROM friend_both GROUP BY a, b"
        ),
        "stream_posts": _plain("SELECT * FROM statusposts"),
        "stream_deliveries": _plain(DELIVERIES),
    }
    # a stream that has taken in everything equals its batch form
    for stream, batch in STREAM_FORMS.items():
        sql[stream] = sql[batch]
    return {name: " ".join(text.split("\n")) for name, text in sql.items()}

