"""SQL that states the expected result of the named queries, for DuckDB.

Written apart from the operators: cleaning goes step by step, tags and tokens are fully
unnested, metrics count single rows. A query without SQL here depends on a fitted model,
on hashing or on file properties.
"""

from __future__ import annotations

from tagloom.catalog import views
from tagloom.functions.tokens import STOP_WORDS
from tagloom.schemas import LABELED_QUESTIONS, POSTS, USERS

_TABLES = {name: name for name in ("documents", "labels", "customer", "nation", "pages")}


def _clean(text: str, url_first: bool = False) -> str:
    patterns = ["<.*?>", r"http\S+"]
    if url_first:
        patterns.reverse()
    for pattern, by in [(p, "") for p in patterns] + [("[^a-zA-Z]", " "), (r"\s+", " ")]:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"trim(lower({text}))"


_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

_STEPS = {
    "posts": views.POSTS.format(**_TABLES),
    "posttypes": views.POST_TYPES,
    "users": views.USERS.format(**_TABLES),
    "web": views.PAGES.format(**_TABLES),
    "bodies": """
        SELECT 'posts' AS origin, id, Body FROM posts
        UNION ALL SELECT 'pages', question_id, Body FROM web""",
    "questions": """
        SELECT p.id AS question_id, p.* EXCLUDE (id, LastEditorDisplayName, ParentId, Tags), t.Type,
               string_split(trim(translate(Tags, '<>', ' ')), ' ') AS tag_list
        FROM posts p JOIN posttypes t ON p.PostTypeId = t.Id
        WHERE t.Type = 'Question'""",
    "prepared": f"SELECT * EXCLUDE (Body), {_clean('Body')} AS Text FROM questions WHERE Body IS NOT NULL",
    "tag_rows": """
        SELECT question_id, regexp_replace(Body, '<.*?>', '', 'g') AS Text, unnest(tag_list) AS tag
        FROM questions""",
    "tagged": "SELECT *, tag_list[-1] AS topic, CreationDate AS day FROM questions WHERE tag_list[-1] IS NOT NULL",
    "corpus": "SELECT * FROM (SELECT question_id, Text, unnest(tag_list) AS tag FROM prepared) WHERE tag <> ''",
    "tokens": """
        SELECT question_id, unnest(range(len(words))) AS position, unnest(words) AS token
        FROM (SELECT question_id, string_split(Text, ' ') AS words FROM prepared)""",
    "corpus_terms": f"""
        SELECT * FROM (
            SELECT row_id, unnest(string_split(Text, ' ')) AS term
            FROM (SELECT row_number() OVER () AS row_id, Text FROM corpus))
        WHERE term NOT IN ({_STOP})""",
    "daily": "SELECT day, topic, count(*) AS n FROM tagged GROUP BY day, topic",
}


def _rule(source: str) -> tuple[str, str]:
    """Rule predictions over ``source`` (questions, prepared or tagged), as two named steps."""
    topics = f"(SELECT *, tag_list[-1] AS rule_topic FROM {source} WHERE tag_list[-1] IS NOT NULL)"
    index = f"""
        SELECT rule_topic, row_number() OVER (ORDER BY count(*) DESC, rule_topic) - 1 AS label_index
        FROM {topics} GROUP BY rule_topic"""
    rule = f"""
        SELECT first_tag, rule_topic AS decoded, label_index
        FROM (SELECT tag_list[1] AS first_tag, rule_topic, count(*) AS n FROM {topics} GROUP BY ALL)
        JOIN ({index}) USING (rule_topic)
        QUALIFY row_number() OVER (PARTITION BY first_tag ORDER BY n DESC, rule_topic) = 1"""
    predicted = f"""
        SELECT s.*, r.decoded, CAST(r.label_index AS INT) AS prediction
        FROM {source} s LEFT JOIN rule r ON s.tag_list[1] = r.first_tag"""
    return rule, predicted


_STEPS["rule"], _STEPS["judged"] = _rule("tagged")
_PREPARED_RULE = dict(zip(("rule", "predicted"), _rule("prepared")))


def _with(select: str, *steps: str, **own: str) -> str:
    """``select`` behind the named steps it needs, in the order of their definition."""
    named = {name: _STEPS[name] for name in steps}
    named.update(own)
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in named.items()) + "\n" + select


_QUESTIONS = ("posts", "posttypes", "questions")
_TAGGED = (*_QUESTIONS, "tagged")
_PREPARED = (*_QUESTIONS, "prepared")
_JUDGED = (*_TAGGED, "rule", "judged")


def _predicted(select: str) -> str:
    return _with(select, *_PREPARED, **_PREPARED_RULE)


_QUESTION_COLUMNS = [
    field
    for field in LABELED_QUESTIONS
    if field.name not in ("Text", "prediction", "decoded", "Tags", "CreationDate", "LastEditDate", "batch_datetime_stamp", "load")
] + [POSTS["Body"]]


def _describe(view: str, schema) -> str:
    parts = []
    for field in schema:
        if field.dataType.simpleString() not in ("int", "float", "string"):
            continue
        number = f"TRY_CAST({field.name} AS DOUBLE)"
        parts.append(
            f"SELECT '{field.name}' AS column_name, count({field.name}) AS n, round(avg({number}), 6) AS mean, "
            f"round(stddev_samp({number}), 6) AS stddev, CAST(min({field.name}) AS VARCHAR) AS min, "
            f"CAST(max({field.name}) AS VARCHAR) AS max FROM {view}"
        )
    return " UNION ALL ".join(parts)


def _null_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, count(*) AS rows, count(*) - count({f.name}) AS nulls FROM posts"
        for f in POSTS
    )


# Text posts of which some values do not convert; see the query of the same name.
_LOST = {"CreationDate": "AnswerCount = 3", "CommentCount": "CommentCount = 5", "Score": "Score = 4"}


def _conform_posts() -> str:
    columns = [
        f"CASE WHEN NOT ({_LOST[f.name]}) THEN {f.name} END AS {f.name}" if f.name in _LOST else f.name for f in POSTS
    ]
    lost = " + ".join(f"CAST({condition} AS INT)" for condition in _LOST.values())
    return f"SELECT {', '.join(columns)}, {lost} AS values_lost FROM posts"


def _conform_losses(everywhere: tuple[str, ...] | None = None) -> str:
    """Values given and lost per column; posts of odd id have only the columns ``everywhere``."""
    return " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, count({f.name}) AS values_given, "
        f"count(*) FILTER ({_LOST.get(f.name, 'false')}) AS values_lost FROM posts"
        + (" WHERE id % 2 = 0" if everywhere and f.name not in everywhere else "")
        for f in POSTS
    )


# The questions that a model learns from, one row per tag.
_LEARNED = {
    "parts": "SELECT *, ('0x' || substr(md5(CAST(question_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 90 AS learned FROM prepared",
    "learned": "SELECT * FROM (SELECT Text, unnest(tag_list) AS tag FROM parts WHERE learned) WHERE tag <> ''",
    "learned_terms": "SELECT unnest(string_split(Text, ' ')) AS term FROM learned",
}

_LABELED = """
    question_id, Text, prediction, decoded, AcceptedAnswerId, AnswerCount, CommentCount,
    CAST(CreationDate AS TIMESTAMP) AS CreationDate, FavoriteCount, CAST(LastEditDate AS TIMESTAMP) AS LastEditDate,
    LastEditorUserId, OwnerUserId, PostTypeId, Score, array_to_string(tag_list, ',') AS Tags, Title, ViewCount, Type"""

_BATCHES = """
    SELECT *, TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp FROM predicted
    UNION ALL BY NAME
    SELECT * REPLACE ('edited' AS decoded), TIMESTAMP '2023-10-23 02:00:00' AS batch_datetime_stamp
    FROM predicted WHERE LastEditDate IS NOT NULL
    UNION ALL BY NAME
    SELECT * REPLACE ('liked' AS decoded), TIMESTAMP '2023-10-24 02:00:00' AS batch_datetime_stamp
    FROM predicted WHERE Score > 3"""

_CLASS_METRICS = """
    SELECT class, actual, predicted, hits,
           CASE WHEN predicted = 0 THEN 0.0 ELSE hits::DOUBLE / predicted END AS precision,
           CASE WHEN actual = 0 THEN 0.0 ELSE hits::DOUBLE / actual END AS recall,
           2.0 * hits / (actual + predicted) AS f1
    FROM (SELECT class,
                 (SELECT count(*) FROM judged WHERE topic = class) AS actual,
                 (SELECT count(*) FROM judged WHERE decoded = class) AS predicted,
                 (SELECT count(*) FROM judged WHERE topic = class AND decoded = class) AS hits
          FROM (SELECT topic AS class FROM judged UNION SELECT decoded FROM judged))"""

_ENGAGEMENT = ("AnswerCount", "CommentCount", "FavoriteCount", "Score", "ViewCount")


def _engagement() -> str:
    totals = ", ".join(f"CAST(sum({name}) AS DOUBLE) AS total_{name}" for name in _ENGAGEMENT)
    means = ", ".join(f"round(avg({name}), 6) AS mean_{name}" for name in _ENGAGEMENT)
    return f"""
        SELECT topic, count(*) AS questions, {totals}, {means},
               count(DISTINCT OwnerUserId) AS owners, count(DISTINCT u.id) AS known_owners,
               round((SELECT avg(v.Reputation) FROM users v
                      WHERE v.id IN (SELECT OwnerUserId FROM tagged o WHERE o.topic = tagged.topic)), 6) AS mean_owner_reputation
        FROM tagged LEFT JOIN users u ON tagged.OwnerUserId = u.id
        GROUP BY topic"""


def _summary(select: str, *steps: str) -> str:
    """Over the three batches whose summaries are kept, the second as published again."""
    tagged = """
        SELECT *, CAST(CreationDate AS DATE) AS day, decoded AS topic FROM (
            SELECT * FROM predicted
            UNION ALL BY NAME SELECT * REPLACE ('edited' AS decoded) FROM predicted WHERE LastEditDate IS NOT NULL AND question_id % 3 = 0
            UNION ALL BY NAME SELECT * REPLACE ('liked' AS decoded) FROM predicted WHERE Score > 3
        ) WHERE decoded IS NOT NULL"""
    named = {name: _STEPS[name] for name in steps}
    return _with(select, *_PREPARED, **_PREPARED_RULE, tagged=tagged, **named)


def oracle_sql() -> dict[str, str]:
    old = "CreationDate < DATE '2023-10-15'"
    evolved = f"""SELECT id, CreationDate, Score,
        CASE WHEN NOT ({old}) THEN FavoriteCount END AS FavoriteCount,
        CASE WHEN NOT ({old}) THEN ViewCount END AS ViewCount"""
    return {
        "scan_posts": _with("SELECT * FROM posts", "posts"),
        "csv_roundtrip": _with("SELECT * FROM users", "users"),
        "csv_rejects": """
            SELECT CASE WHEN good THEN CAST(k AS INT) END AS id, CASE WHEN good THEN c_name END AS name, CASE WHEN good THEN 3 END AS kind,
                   CASE WHEN NOT good THEN k || CASE WHEN k % 7 = 0 THEN 'x' ELSE '' END || ',"' || c_name || '"'
                     || CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN ',1,2' ELSE ',3' END END AS line
            FROM (SELECT c_custkey AS k, c_name, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AS good FROM customer)
        """,
        "sample_by_topic": _with(
            "SELECT topic, question_id, Title FROM tagged "
            "QUALIFY row_number() OVER (PARTITION BY topic ORDER BY md5(CAST(question_id AS VARCHAR)), question_id) <= 5",
            *_TAGGED,
        ),
        "streamed_questions": _with(
            "SELECT question_id, tag_list[-1] AS decoded, TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp, "
            "'arrivals-00000' || question_id % 2 AS load FROM prepared",
            *_PREPARED,
        ),
        "full_refresh_dim": _with("SELECT * REPLACE (CAST(UpVotes + 1 AS INT) AS UpVotes) FROM users", "users"),
        "landing_posts": _with(
            "SELECT CreationDate, count(*) AS posts, count(Body) AS bodies, CAST(sum(ViewCount) AS BIGINT) AS views "
            "FROM posts GROUP BY CreationDate",
            "posts",
        ),
        "conform_posts": _with(_conform_posts(), "posts"),
        "conform_losses": _with(_conform_losses(), "posts"),
        "landing_losses": _with(_conform_losses(("id", "Title", "CreationDate", "Score", "CommentCount")), "posts"),
        "checkpoint_roundtrip": _with(
            "SELECT question_id, Text, unnest(tag_list) AS tag FROM prepared", *_PREPARED
        ),
        "schema_evolution": _with(
            f"{evolved}, CAST(CASE WHEN {old} THEN 1 ELSE 2 END AS INT) AS version FROM posts", "posts"
        ),
        "schema_union": _with(f"{evolved} FROM posts", "posts"),
        "null_counts": _with(_null_counts(), "posts"),
        "describe_posts": _with(_describe("posts", POSTS), "posts"),
        "describe_users": _with(_describe("users", USERS), "users"),
        "describe_questions": _with(
            _describe("questions", _QUESTION_COLUMNS), *_QUESTIONS
        ),
        "preview_questions": _with(
            "SELECT question_id, Title, Score, ViewCount FROM questions ORDER BY question_id LIMIT 20", *_QUESTIONS
        ),
        "distinct_tags": _with(
            "SELECT count(*) AS rows, count(DISTINCT tag) AS distinct_tag, "
            "count(DISTINCT question_id) AS distinct_question_id FROM tag_rows",
            *_QUESTIONS,
            "tag_rows",
        ),
        "posts_with_type": _with(
            "SELECT Type, count(*) AS posts FROM posts JOIN posttypes ON PostTypeId = posttypes.Id GROUP BY Type",
            "posts",
            "posttypes",
        ),
        "question_posts": _with(
            "SELECT * EXCLUDE (tag_list), array_to_string(tag_list, ',') AS Tags FROM questions", *_QUESTIONS
        ),
        "parse_tags": _with(
            "SELECT id, array_to_string(tags, ',') AS tags, len(tags) AS n_tags FROM "
            "(SELECT id, string_split(trim(translate(Tags, '<>', ' ')), ' ') AS tags FROM posts)",
            "posts",
        ),
        "strip_html": _with(
            "SELECT origin, id, regexp_replace(Body, '<.*?>', '', 'g') AS text FROM bodies", "posts", "web", "bodies"
        ),
        "strip_urls": _with(
            r"SELECT origin, id, regexp_replace(Body, 'http\S+', '', 'g') AS text FROM bodies", "posts", "web", "bodies"
        ),
        "clean_text_train": _with(
            f"SELECT origin, id, {_clean('Body')} AS text FROM bodies", "posts", "web", "bodies"
        ),
        "clean_text_infer": _with(
            f"SELECT origin, id, {_clean('Body', url_first=True)} AS text FROM bodies", "posts", "web", "bodies"
        ),
        "ml_input": _with("SELECT question_id, Text FROM prepared", *_PREPARED),
        "ml_input_url_first": _with(
            f"SELECT question_id, {_clean('Body', url_first=True)} AS Text FROM questions WHERE Body IS NOT NULL",
            *_QUESTIONS,
        ),
        "text_and_tags": _with("SELECT * FROM tag_rows", *_QUESTIONS, "tag_rows"),
        "training_corpus": _with("SELECT * FROM corpus", *_PREPARED, "corpus"),
        "tokens": _with("SELECT * FROM tokens", *_PREPARED, "tokens"),
        "filtered_tokens": _with(
            "SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY position) - 1 AS position, token "
            f"FROM tokens WHERE token NOT IN ({_STOP})",
            *_PREPARED,
            "tokens",
        ),
        "term_frequency": _with(
            "SELECT term, n, row_number() OVER (ORDER BY n DESC, term) - 1 AS term_index "
            "FROM (SELECT term, count(*) AS n FROM corpus_terms GROUP BY term)",
            *_PREPARED,
            "corpus",
            "corpus_terms",
        ),
        "idf_weights": _with(
            "SELECT term, df, CASE WHEN df >= 5 THEN round(ln(((SELECT count(*) FROM corpus) + 1.0) / (df + 1.0)), 6) "
            "ELSE 0.0 END AS idf "
            "FROM (SELECT term, count(DISTINCT row_id) AS df FROM corpus_terms GROUP BY term)",
            *_PREPARED,
            "corpus",
            "corpus_terms",
        ),
        "hashing_tf_totals": _with(
            f"SELECT question_id, count(*) AS tokens FROM tokens WHERE token NOT IN ({_STOP}) GROUP BY question_id",
            *_PREPARED,
            "tokens",
        ),
        "label_index": _with(
            "SELECT tag, n, row_number() OVER (ORDER BY n DESC, tag) - 1 AS label_index "
            "FROM (SELECT tag, count(*) AS n FROM tag_rows GROUP BY tag)",
            *_QUESTIONS,
            "tag_rows",
        ),
        "train_test_split": _with(
            "SELECT question_id, CASE WHEN ('0x' || substr(md5(CAST(question_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 90 "
            "THEN 'train' ELSE 'test' END AS part FROM questions",
            *_QUESTIONS,
        ),
        "train_topic_model": _with(
            "SELECT (SELECT count(*) FROM parts WHERE NOT learned) AS held_out, count(DISTINCT tag) AS classes, "
            f"(SELECT least(65536, count(DISTINCT term)) FROM learned_terms WHERE term NOT IN ({_STOP})) AS vocabulary "
            "FROM learned",
            *_PREPARED,
            **_LEARNED,
        ),
        "stored_label_index": _with(
            "SELECT tag, row_number() OVER (ORDER BY n DESC, tag) - 1 AS label_index "
            "FROM (SELECT tag, count(*) AS n FROM learned GROUP BY tag)",
            *_PREPARED,
            **_LEARNED,
        ),
        "infer_topics": _with("SELECT question_id, Text, true AS tagged FROM prepared", *_PREPARED),
        "infer_coverage": _with(
            "SELECT count(*) AS rows, count(DISTINCT question_id) AS questions, count(*) AS known_tags FROM prepared",
            *_PREPARED,
        ),
        "eval_topic_model": _with(
            "SELECT count(*) AS scored, true AS above_floor "
            "FROM (SELECT unnest(tag_list) AS tag FROM parts WHERE NOT learned) WHERE tag <> ''",
            *_PREPARED,
            **_LEARNED,
        ),
        "train_tag_blocks": _with(
            "SELECT (SELECT count(*) FROM (SELECT unnest(tag_list) AS tag FROM parts WHERE NOT learned) WHERE tag <> '') AS scored, "
            "count(DISTINCT tag) AS tags, (count(DISTINCT tag) + 9) // 10 AS blocks, true AS as_good FROM learned",
            *_PREPARED,
            **_LEARNED,
        ),
        "decode_labels": _with(
            "SELECT question_id, CAST(prediction AS BIGINT) AS prediction, decoded FROM judged "
            "WHERE prediction IS NOT NULL",
            *_JUDGED,
        ),
        "confusion_matrix": _with(
            "SELECT topic AS label, decoded AS prediction, count(*) AS n FROM judged GROUP BY topic, decoded", *_JUDGED
        ),
        "class_metrics": _with(
            f"SELECT class, actual, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            f"round(f1, 6) AS f1 FROM ({_CLASS_METRICS})",
            *_JUDGED,
        ),
        "eval_metrics": _with(
            "SELECT CAST(sum(actual) AS BIGINT) AS rows, "
            "(SELECT round(avg(CAST(topic = decoded AS INT)), 6) FROM judged) AS accuracy, "
            f"round(sum(f1 * actual) / sum(actual), 6) AS weighted_f1 FROM ({_CLASS_METRICS})",
            *_JUDGED,
        ),
        "any_tag_accuracy": _with(
            "SELECT count(*) AS questions, round(avg(CAST(list_contains(tag_list, decoded) AS INT)), 6) "
            "AS any_tag_accuracy FROM judged",
            *_JUDGED,
        ),
        "merge_predictions": _predicted(
            "SELECT * EXCLUDE (tag_list), array_to_string(tag_list, ',') AS Tags FROM predicted"
        ),
        "labeled_questions": _predicted(
            f"SELECT {_LABELED}, TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp, 'all' AS load FROM predicted"
        ),
        "two_loads_one_hour": _predicted(
            "SELECT question_id, decoded, TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp, "
            "CASE WHEN question_id % 2 = 0 THEN 'even' ELSE 'odd' END AS load "
            "FROM predicted WHERE question_id % 2 = 1 OR Score > 0"
        ),
        "published_engagement": _with(
            _engagement(),
            *_PREPARED,
            "users",
            **_PREPARED_RULE,
            tagged=f"SELECT *, decoded AS topic FROM (SELECT * FROM ({_BATCHES}) "
            "WHERE batch_datetime_stamp <= TIMESTAMP '2023-10-23 12:00:00' "
            "QUALIFY rank() OVER (PARTITION BY question_id ORDER BY batch_datetime_stamp DESC) = 1) WHERE decoded IS NOT NULL",
        ),
        "published_top10_daily": _predicted(
            "SELECT day, topic, n, row_number() OVER (PARTITION BY day ORDER BY n DESC, topic) AS rank FROM ("
            "SELECT CAST(CreationDate AS DATE) AS day, decoded AS topic, count(*) AS n FROM ("
            f"SELECT * FROM ({_BATCHES}) WHERE batch_datetime_stamp <= TIMESTAMP '2023-10-23 12:00:00' "
            "QUALIFY rank() OVER (PARTITION BY question_id ORDER BY batch_datetime_stamp DESC) = 1) "
            "WHERE decoded IS NOT NULL GROUP BY 1, 2) QUALIFY rank <= 10"
        ),
        "as_of_predictions": _predicted(
            f"SELECT question_id, decoded, batch_datetime_stamp FROM ({_BATCHES}) "
            "WHERE batch_datetime_stamp <= TIMESTAMP '2023-10-23 12:00:00' "
            "QUALIFY rank() OVER (PARTITION BY question_id ORDER BY batch_datetime_stamp DESC) = 1"
        ),
        "batch_history": _predicted(
            "SELECT batch_datetime_stamp, count(*) AS rows, count(DISTINCT question_id) AS questions "
            f"FROM ({_BATCHES}) GROUP BY batch_datetime_stamp"
        ),
        "history_after_republish": _predicted(
            "SELECT state, question_id, CASE WHEN corrected THEN 'corrected' ELSE decoded END AS decoded, "
            "TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp, CASE question_id % 2 WHEN 0 THEN 'first' ELSE 'it''s' END AS load "
            "FROM (SELECT *, state >= 'after 2' AND question_id % 2 = 0 AS corrected FROM predicted, "
            "(VALUES ('after 0'), ('after 1'), ('after 2'), ('after 3'), ('after 4'), ('now')) AS states(state)) "
            "WHERE CASE question_id % 2 WHEN 0 THEN NOT corrected OR Score > 0 ELSE state NOT IN ('after 0', 'after 3') END"
        ),
        "publications": _predicted(
            "SELECT load, (SELECT count(*) FROM predicted WHERE question_id % 2 = part AND Score > least) AS rows, "
            "TIMESTAMP '2023-10-24 03:00:00' + minute * INTERVAL 1 MINUTE AS published_at, "
            "TIMESTAMP '2023-10-24 03:00:00' + until * INTERVAL 1 MINUTE AS replaced_at "
            "FROM (VALUES ('first', 0, 0, 2, NULL), ('it''s', 1, 1000, 3, 4), ('it''s', 1, -1000, 4, NULL)) AS listed(load, part, least, minute, until)"
        ),
        "published_evolution": _predicted(
            "SELECT question_id, decoded, CAST(ViewCount AS BIGINT) AS ViewCount, CAST(NULL AS DOUBLE) AS certainty, "
            "TIMESTAMP '2023-10-22 02:00:00' AS batch_datetime_stamp FROM predicted UNION ALL "
            "SELECT question_id, decoded, ViewCount + 1099511627776, CAST(Score AS DOUBLE) / 2, TIMESTAMP '2023-10-23 02:00:00' FROM predicted WHERE Score > 3"
        ),
        "compacted_publication": _predicted(
            "SELECT CAST(state AS INT) AS state, count(*) AS rows, CAST(sum(question_id) AS BIGINT) AS ids, count(decoded) AS decoded, state = 0 AS many_files "
            "FROM predicted, (VALUES (0), (1)) AS states(state) GROUP BY state"
        ),
        "users_dim": _with(
            "SELECT id, CreationDate, CAST(year(CreationDate) AS INT) AS Year, CAST(month(CreationDate) AS INT) AS Month, "
            "DisplayName, DownVotes, Location, Reputation, UpVotes, Views, AccountId, "
            "TIMESTAMP '2023-10-22 02:00:00' AS processing_datetime_stamp FROM users",
            "users",
        ),
        "topic_totals": _with(
            "SELECT topic, count(*) AS qty FROM tagged GROUP BY topic ORDER BY qty DESC, topic LIMIT 20", *_TAGGED
        ),
        "topic_daily": _with("SELECT * FROM daily", *_TAGGED, "daily"),
        "topic_trend": _with(
            "SELECT d.day, d.topic, d.n, coalesce(p.n, 0) AS previous_n, "
            "round(d.n / (SELECT sum(n) FROM daily w WHERE w.day = d.day), 6) AS share, "
            "d.n - coalesce(p.n, 0) AS change "
            "FROM daily d LEFT JOIN daily p ON p.topic = d.topic AND p.day = d.day - 1",
            *_TAGGED,
            "daily",
        ),
        "top10_topics_daily": _with(
            "SELECT day, topic, n, row_number() OVER (PARTITION BY day ORDER BY n DESC, topic) AS rank "
            "FROM daily QUALIFY rank <= 10",
            *_TAGGED,
            "daily",
        ),
        "engagement_by_topic": _with(_engagement(), *_TAGGED, "users"),
        "summary_trend": _summary(
            "SELECT d.day, d.topic, d.n, coalesce(p.n, 0) AS previous_n, "
            "round(d.n / (SELECT sum(n) FROM daily w WHERE w.day = d.day), 6) AS share, d.n - coalesce(p.n, 0) AS change "
            "FROM daily d LEFT JOIN daily p ON p.topic = d.topic AND p.day = d.day - 1",
            "daily",
        ),
        "summary_engagement": _summary(_engagement(), "users"),
        "summary_drilldown": _summary(
            "SELECT Type, topic, day, count(*) AS n, CAST(grouping_id(Type, topic, day) AS BIGINT) AS level FROM tagged GROUP BY ROLLUP (Type, topic, day)"
        ),
        "distinct_by_range": _with(
            "SELECT span, count(DISTINCT OwnerUserId) AS n_owners, count(DISTINCT Title) AS n_titles, true AS owners_near, true AS titles_near "
            "FROM (SELECT *, unnest(['week ' || (day(CreationDate) - 1) // 7, 'month', "
            "CASE WHEN day(CreationDate) > 14 THEN 'half' ELSE 'first half' END]) AS span FROM posts) GROUP BY span",
            "posts",
        ),
        "auc_by_topic": _with(
            "SELECT topic, CAST(sum(positives) AS BIGINT) AS positives, CAST(sum(negatives) AS BIGINT) AS negatives, "
            "round(sum(positives * (below + negatives / 2)) / (sum(positives) * sum(negatives)), 6) AS auc "
            "FROM (SELECT *, coalesce(sum(negatives) OVER (PARTITION BY topic ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ("
            "SELECT t.topic, coalesce(n, 0) / cell_n AS score, sum(coalesce(n, 0)) AS positives, sum(cell_n - coalesce(n, 0)) AS negatives "
            "FROM (SELECT tag_list[1] AS first_tag, day, count(*) AS cell_n FROM tagged GROUP BY ALL) c, (SELECT DISTINCT topic FROM tagged) t "
            "LEFT JOIN (SELECT tag_list[1] AS first_tag, day, topic, count(*) AS n FROM tagged GROUP BY ALL) f "
            "ON f.first_tag = c.first_tag AND f.day = c.day AND f.topic = t.topic GROUP BY 1, 2)) GROUP BY topic",
            *_TAGGED,
        ),
        "topic_drilldown": _with(
            "SELECT Type, topic, day, count(*) AS n, CAST(grouping_id(Type, topic, day) AS BIGINT) AS level "
            "FROM tagged GROUP BY ROLLUP (Type, topic, day)",
            *_TAGGED,
        ),
    }
