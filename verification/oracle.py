"""The same results in plain SQL over the driver's tables."""

from __future__ import annotations

from reviewlake.functions.pseudonym import hmac_pads
from verification.adapter import SALT

_IPAD, _OPAD = hmac_pads(SALT)


def _hmac(identifier: str) -> str:
    return (
        f"sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode({identifier}))))"
    )


_SPACES = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _clean(text: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace({text}, '\[/?[a-zA-Z*]+(?:=[^\]]*)?\]', '', 'g'), "
        rf"'{_SPACES}', ' ', 'g'))"
    )


_RAW = r"""
joined AS (
  SELECT d.doc_id, d.text, d.lang, e.*, CAST(regexp_extract(d.source, 'src(\d+)', 1) AS BIGINT) AS num,
         CAST(regexp_extract(e.props, '"k": *(\d+)', 1) AS BIGINT) AS k,
         epoch_us(e.ts) // 1000000 AS secs,
         coalesce(l.toxic = 1, false) AS toxic_,
         coalesce(l.toxic = 1, false) OR coalesce(l.quality = 0, false) AS negative_,
         coalesce(l.quality = 1 AND NOT coalesce(l.toxic = 1, false), false) AS praised
  FROM documents d JOIN events e ON d.doc_id = e.event_id LEFT JOIN labels l ON d.doc_id = l.doc_id
),
base AS (
  SELECT CAST(doc_id AS VARCHAR) AS rid,
    CASE WHEN NOT (event_type = 'view' AND value > 150) THEN CAST(user_id AS VARCHAR) END AS steamid,
    CASE WHEN event_type <> 'error' THEN k END AS playtime,
    CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE 'spanish' END AS language,
    CASE WHEN value < 0.5 THEN '[i] [/i]'
         WHEN event_type = 'click' THEN '[b]' || text || '[/b]'
         WHEN event_type = 'signup' THEN chr(12288) || text || chr(160) || chr(8232) || '!'
         ELSE text END AS review,
    secs AS created,
    CASE WHEN NOT (event_type = 'purchase' AND value > 100) THEN secs + 60 * k END AS updated,
    secs + 60 * k AS full_updated,
    NOT negative_ AS voted_up,
    CAST(floor(value) AS BIGINT) AS votes_up,
    value / 500 AS wvs,
    CAST(CASE WHEN num = 19 THEN 4000000 WHEN num % 3 = 0 THEN 1086940 WHEN num % 3 = 1 THEN 1903340 ELSE 2622380 END AS BIGINT) AS app_id,
    CASE WHEN toxic_ THEN 'negative_boost' ELSE 'natural' END AS sample_source,
    'a' AS source_file, toxic_, praised
  FROM joined
),
raw AS (
  SELECT * FROM base
  UNION ALL BY NAME
  SELECT * REPLACE ('negative_boost' AS sample_source, 'b' AS source_file, full_updated + 7200 AS updated)
  FROM base WHERE NOT voted_up AND NOT toxic_
  UNION ALL BY NAME
  SELECT * REPLACE ('old version ' || review AS review, 'c' AS source_file, full_updated - 7200 AS updated)
  FROM base WHERE praised
)"""

_DEDUP = """,
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY (sample_source <> 'natural'), updated DESC NULLS LAST,
                                 source_file, review) AS rn FROM raw)
  WHERE rn = 1
)"""

_SILVER = (
    _RAW
    + _DEDUP
    + f""",
silver AS (
  SELECT * FROM (
    SELECT rid AS review_id, app_id, language, {_clean('review')} AS review_text,
      CAST(voted_up AS BIGINT) AS label, make_timestamp(created * 1000000) AS created_at,
      make_timestamp(coalesce(updated, created) * 1000000) AS updated_at, votes_up,
      wvs AS weighted_vote_score, coalesce(playtime, 0) AS playtime_at_review_min,
      {_hmac("coalesce(steamid, '')")} AS author_pseudo, sample_source
    FROM dedup)
  WHERE review_text <> ''
),
silver_len AS (SELECT *, length(review_text) AS text_len FROM silver)"""
)

_TERMS = (
    _SILVER
    + r""",
tokens AS (
  SELECT review_id, label, unnest(regexp_extract_all(lower(review_text), '[\p{L}\p{N}_]{2,}')) AS term FROM silver
),
doc_terms AS (SELECT review_id, label, term, count(*) AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT count(*) AS n, count(*) FILTER (label = 0) AS n_neg, count(*) FILTER (label = 1) AS n_pos FROM silver),
stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, count(*) FILTER (label = 0) AS df_neg
  FROM doc_terms GROUP BY term HAVING count(*) >= 2 ORDER BY cf DESC, sha256(term) LIMIT 100000
),
model AS (
  SELECT term, df, cf, ln((1 + n) / (1 + df)) + 1 AS idf,
    ln((df_neg + n_neg / n) / (n_neg + 1)) - ln((df - df_neg + n_pos / n) / (n_pos + 1)) AS coef_neg
  FROM stats, sizes
),
stable AS (SELECT term, idf, round(coef_neg, 9) AS coef_neg FROM model)"""
)


def _weights(model: str = "model") -> str:
    return f"""
weighted AS (
  SELECT t.review_id, t.term, (1 + ln(tf)) * idf AS raw_w, coef_neg
  FROM doc_terms t JOIN {model} USING (term)
)"""


_PRED = (
    _TERMS
    + ","
    + _weights()
    + """,
dots AS (
  SELECT review_id, sum(raw_w * coef_neg) / sqrt(sum(raw_w * raw_w)) AS margin FROM weighted GROUP BY review_id
),
pred AS (
  SELECT review_id, app_id, language, sample_source, created_at, label, proba_negative,
    CAST(CASE WHEN proba_negative >= 0.6 THEN 0 ELSE 1 END AS BIGINT) AS pred_label,
    CAST(0.6 AS DOUBLE) AS decision_threshold,
    CASE WHEN CAST(review_id AS BIGINT) % 2 = 1 THEN '9' ELSE '10' END AS model_version
  FROM (SELECT s.*, 1 / (1 + exp(-coalesce(margin, 0))) AS proba_negative FROM silver s LEFT JOIN dots USING (review_id))
)"""
)

_GOLD = (
    _PRED
    + """,
games AS (
  SELECT CAST(app_id AS BIGINT) AS app_id, game_name FROM (VALUES (1086940, 'Baldur''s Gate 3'),
    (1903340, 'Clair Obscur: Expedition 33'), (2622380, 'ELDEN RING NIGHTREIGN')) t(app_id, game_name)
),
fact AS (
  SELECT s.review_id, s.app_id, s.language, s.sample_source, CAST(s.created_at AS DATE) AS review_date,
    s.created_at, s.label, p.pred_label, p.proba_negative, p.decision_threshold, p.model_version,
    s.votes_up, s.playtime_at_review_min, s.text_len
  FROM silver_len s JOIN pred p USING (review_id)
),
mart AS (
  SELECT app_id, game_name, language, review_date, count(*) AS n_reviews,
    count(*) FILTER (pred_label = 0) AS n_pred_negative, count(*) FILTER (label = 0) AS n_actual_negative,
    count(*) FILTER (pred_label = 0) / count(*) AS share_pred_negative,
    count(*) FILTER (label = 0) / count(*) AS share_actual_negative,
    CAST(max(CAST(model_version AS BIGINT)) AS VARCHAR) AS model_version
  FROM fact JOIN games USING (app_id) WHERE sample_source = 'natural'
  GROUP BY app_id, game_name, language, review_date
),
summary AS (
  SELECT app_id, language, CAST(created_at AS DATE) AS date, count(*) AS n_reviews,
    count(*) FILTER (pred_label = 0) / count(*) AS share_negative_pred,
    count(*) FILTER (label = 0) / count(*) AS share_negative_true,
    arg_min(model_version, (created_at, model_version)) AS model_version
  FROM pred WHERE sample_source = 'natural' GROUP BY ALL
)"""
)

_HALVES = (
    _SILVER
    + """,
halves AS (
  SELECT *, CASE WHEN rk <= n // 2 THEN 'reference' ELSE 'current' END AS half
  FROM (SELECT *, row_number() OVER (ORDER BY created_at, sha256(review_id)) AS rk, count(*) OVER () AS n
        FROM silver_len WHERE sample_source = 'natural')
)"""
)

_PSI = """,
edges AS (
  SELECT DISTINCT unnest(quantile_cont(text_len, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS q
  FROM halves WHERE half = 'reference'
),
placed AS (
  SELECT half, CASE WHEN text_len = (SELECT min(q) FROM edges) THEN 1
                    ELSE (SELECT count(*) FROM edges WHERE q < text_len) END AS bin
  FROM halves
),
bins AS (
  SELECT b.bin, count(*) FILTER (half = 'reference') AS r, count(*) FILTER (half = 'current') AS c
  FROM (SELECT unnest(range(1, (SELECT count(*) FROM edges))) AS bin) b LEFT JOIN placed p ON p.bin = b.bin GROUP BY b.bin
),
psi_num AS (
  SELECT 'text_len' AS "column", coalesce(sum((pc - pr) * ln(pc / pr)), 0) AS psi
  FROM (SELECT CASE WHEN r = 0 THEN 1e-6 ELSE r / (SELECT sum(r) FROM bins) END AS pr,
               CASE WHEN c = 0 THEN 1e-6 ELSE c / (SELECT sum(c) FROM bins) END AS pc FROM bins)
),
cats AS (
  SELECT half, unnest(['language', 'app_id', 'sample_source']) AS "column",
         unnest([language, CAST(app_id AS VARCHAR), sample_source]) AS v FROM halves
),
cat_counts AS (
  SELECT "column", v, count(*) FILTER (half = 'reference') AS r, count(*) FILTER (half = 'current') AS c
  FROM cats GROUP BY ALL
),
psi_cat AS (
  SELECT "column", sum((pc - pr) * ln(pc / pr)) AS psi
  FROM (SELECT "column", CASE WHEN r = 0 THEN 1e-6 ELSE r / sum(r) OVER (PARTITION BY "column") END AS pr,
               CASE WHEN c = 0 THEN 1e-6 ELSE c / sum(c) OVER (PARTITION BY "column") END AS pc FROM cat_counts)
  GROUP BY "column"
),
psi_all AS (
  SELECT *, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'à surveiller' ELSE 'dérive' END AS interpretation
  FROM (SELECT * FROM psi_num UNION ALL SELECT * FROM psi_cat)
)"""

_RATIOS = """,
ratios AS (
  SELECT app_id, language, date, share_negative_pred / share_negative_true AS ratio,
    NOT (share_negative_pred / share_negative_true BETWEEN 0.5 AND 2.0) AS out_of_bounds
  FROM summary WHERE n_reviews >= 2 AND share_negative_true <> 0
)"""


def _confusion(group: str = "") -> str:
    return f"""
  SELECT {group} count(*) AS n_rows, count(*) FILTER (label = 0 AND pred_label = 0) AS h,
    count(*) FILTER (label = 1 AND pred_label = 0) AS f, count(*) FILTER (label = 0 AND pred_label = 1) AS m,
    count(*) FILTER (label = 1 AND pred_label = 1) AS o"""


_F1 = """((CASE WHEN 2*h+f+m = 0 THEN 0.0 ELSE CAST(2*h AS DOUBLE)/(2*h+f+m) END)
  + (CASE WHEN 2*o+f+m = 0 THEN 0.0 ELSE CAST(2*o AS DOUBLE)/(2*o+f+m) END)) / 2"""
_RECALL = "(CASE WHEN h+m = 0 THEN 0.0 ELSE CAST(h AS DOUBLE)/(h+m) END)"
_PRECISION = "(CASE WHEN h+f = 0 THEN 0.0 ELSE CAST(h AS DOUBLE)/(h+f) END)"

_CURVE = (
    _PRED
    + f""",
grid AS (SELECT CAST(round(0.30 + 0.025 * i, 3) AS DOUBLE) AS threshold FROM range(21) t(i)),
decided AS (
  SELECT threshold, label, CASE WHEN proba_negative >= threshold THEN 0 ELSE 1 END AS pred_label FROM pred, grid
),
confused AS ({_confusion('threshold,')} FROM decided GROUP BY threshold),
curve AS (SELECT threshold, {_F1} AS f1_macro FROM confused)"""
)

_RUNS = (
    _GOLD
    + f""",
run_counts AS ({_confusion('app_id, CAST(created_at AS DATE) AS day,')} FROM pred GROUP BY app_id, CAST(created_at AS DATE)),
runs AS (
  SELECT CAST(app_id AS VARCHAR) || '-' || CAST(day AS VARCHAR) AS run_id, app_id, day, {_F1} AS f1_macro,
    1.0 - {_F1} AS train_test_gap FROM run_counts
),
champions AS (
  SELECT *, max(f1_macro) FILTER (f1_macro >= 0.7) OVER (PARTITION BY app_id ORDER BY day
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_f1 FROM runs
),
history AS (
  SELECT *, f1_macro >= 0.7 AND (champion_f1 IS NULL OR f1_macro > champion_f1) AS promoted FROM champions
),
moves AS (
  SELECT 'champion' AS alias, CAST(day - DATE '2020-01-01' AS BIGINT) AS version FROM history WHERE promoted
  UNION ALL SELECT 'challenger', CAST(day - DATE '2020-01-01' AS BIGINT) FROM history
),
aliases AS (SELECT alias, max(version) AS version FROM moves GROUP BY alias)"""
)


def _suite(suite: str, source: str, checks: list[tuple[str, str | None, str]]) -> str:
    lines = []
    for check, column, unexpected in checks:
        name = "NULL" if column is None else f"'{column}'"
        lines.append(
            f"SELECT '{suite}' AS suite, '{check}' AS \"check\", CAST({name} AS VARCHAR) AS \"column\", "
            f"CAST(({unexpected}) AS BIGINT) AS unexpected_count"
        )
    body = " UNION ALL ".join(lines).replace("@", source)
    return f"SELECT suite, \"check\", \"column\", unexpected_count = 0 AS success, unexpected_count FROM ({body})"


def _bad(condition: str) -> str:
    return f"SELECT count(*) FROM @ WHERE {condition}"


_ROWS = ("row_count", None, "SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM @")


def _not_null(c: str):
    return ("not_null", c, _bad(f"{c} IS NULL"))


def _unique(c: str):
    return (
        "unique",
        c,
        f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM @ WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
    )


def _in(c: str, values: str):
    return ("in_set", c, _bad(f"{c} NOT IN ({values})"))


def _range(c: str, condition: str):
    return ("between", c, _bad(condition.replace("#", c)))


_FOUR = "'english', 'french', 'german', 'spanish'"
_TWO = "'english', 'french'"
_FLOWS = "'natural', 'negative_boost'"
_PSEUDO = ("matches", "author_pseudo", _bad("NOT regexp_matches(author_pseudo, '^[0-9a-f]{64}$')"))

_CLEAN_CHECKS = [
    ("columns_match", None, "SELECT 0"),
    _ROWS,
    *[_not_null(c) for c in ("review_id", "review_text", "created_at", "author_pseudo")],
    _unique("review_id"),
    _in("label", "0, 1"),
    _in("language", _FOUR),
    _in("sample_source", _FLOWS),
    _range("text_len", "# < 1"),
    _range("weighted_vote_score", "# < 0 OR # > 1"),
    _range("votes_up", "# < 0"),
    _range("playtime_at_review_min", "# < 0"),
    _PSEUDO,
]
_SILVER_CHECKS = [
    _ROWS,
    _not_null("review_id"),
    _unique("review_id"),
    _in("label", "0, 1"),
    _in("language", _TWO),
    _in("sample_source", _FLOWS),
    _range("text_len", "# < 1"),
    _PSEUDO,
]
_PRED_CHECKS = [
    _ROWS,
    _not_null("review_id"),
    _unique("review_id"),
    _in("pred_label", "0, 1"),
    _range("proba_negative", "# < 0 OR # > 1"),
    _range("decision_threshold", "# < 0 OR # > 1"),
    _not_null("model_version"),
]
_FACT_CHECKS = [
    _ROWS,
    _not_null("review_id"),
    _unique("review_id"),
    _in("pred_label", "0, 1"),
    _range("proba_negative", "# < 0 OR # > 1"),
    _in("sample_source", _FLOWS),
    _in("language", _FOUR),
]
_MART_CHECKS = [
    _ROWS,
    _range("n_reviews", "# < 1"),
    _range("share_pred_negative", "# < 0 OR # > 1"),
    _range("share_actual_negative", "# < 0 OR # > 1"),
    _range("n_pred_negative", "# < 0"),
    _range("n_actual_negative", "# < 0"),
    _in("language", _TWO),
]
_SUITES_SILVER = " UNION ALL ".join(
    [
        _suite("clean_zone", "silver_len", _CLEAN_CHECKS),
        _suite("silver_reviews", "silver_len", _SILVER_CHECKS),
        _suite("silver_predictions", "pred", _PRED_CHECKS),
    ]
)
_SUITES_GOLD = " UNION ALL ".join(
    [_suite("gold_facts", "fact", _FACT_CHECKS), _suite("gold_mart", "mart", _MART_CHECKS)]
)
_GATE = _suite(
    "gate",
    "silver_len",
    [
        _ROWS,
        _not_null("review_id"),
        _unique("review_id"),
        _in("label", "0, 1"),
        _in("language", _FOUR),
        _in("sample_source", _FLOWS),
        _range("text_len", "# < 1"),
        _PSEUDO,
        (
            "negative_share",
            "label",
            "SELECT CASE WHEN avg(1 - label) BETWEEN 0.005 AND 0.95 THEN 0 ELSE 1 END FROM @ "
            "WHERE sample_source = 'natural'",
        ),
    ],
)

_CLEAN_COLUMNS = (
    "review_id, app_id, language, review_text, label, created_at, updated_at, votes_up, "
    "round(weighted_vote_score, 6) AS weighted_vote_score, playtime_at_review_min, author_pseudo, text_len, sample_source"
)
_SUMMARY_COLUMNS = (
    "app_id, language, n_reviews, round(share_negative_pred, 6) AS share_negative_pred, "
    "round(share_negative_true, 6) AS share_negative_true, model_version"
)
_NATURAL_RANK = (
    "SELECT review_id, label, row_number() OVER (PARTITION BY label ORDER BY sha256(review_id || '#42')) AS rk, "
    "count(*) OVER (PARTITION BY label) AS n FROM silver WHERE sample_source = 'natural'"
)
_GLOBAL = """
SELECT * FROM (SELECT 'negative' AS direction, term, coef_neg AS weight FROM stable WHERE coef_neg > 0 ORDER BY weight DESC, term LIMIT {n})
UNION ALL
SELECT * FROM (SELECT 'positive' AS direction, term, -coef_neg AS weight FROM stable WHERE coef_neg < 0 ORDER BY weight DESC, term LIMIT {n})"""


def _local(model: str, n: int) -> str:
    return f"""{_weights(model)},
contributions AS (
  SELECT review_id, term, raw_w * coef_neg AS push, raw_w / sqrt(sum(raw_w * raw_w) OVER (PARTITION BY review_id)) * coef_neg AS contribution FROM weighted
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY round(abs(push), 9) DESC, term) AS rk FROM contributions
),
top_terms AS (
  SELECT s.review_id, CAST(rk AS INTEGER) AS rank, term, contribution FROM silver s LEFT JOIN (SELECT * FROM ranked WHERE rk <= {n}) r USING (review_id)
)"""


def all_oracles() -> dict[str, str]:
    """Query name to SQL."""
    sql = {
        "silver_clean": f"WITH {_SILVER} SELECT {_CLEAN_COLUMNS} FROM silver_len",
        "snapshot_history": f"""WITH {_SILVER}, n AS (SELECT count(*) AS a, count(*) FILTER (sample_source = 'natural') AS b FROM silver)
          SELECT 1 AS snapshot_id, 'overwrite' AS operation, a AS n_rows, true AS current FROM n
          UNION ALL SELECT 2, 'overwrite', b, false FROM n UNION ALL SELECT 1, 'restore', a, true FROM n""",
        "time_travel": f"""WITH {_SILVER} SELECT {_CLEAN_COLUMNS} FROM silver_len
          UNION ALL SELECT {_CLEAN_COLUMNS} FROM silver_len WHERE sample_source = 'natural'""",
        "raw_roundtrip": f"""WITH {_RAW} SELECT rid AS recommendationid, sample_source, app_id, language, review, voted_up, votes_up,
          created AS timestamp_created FROM raw
          QUALIFY row_number() OVER (PARTITION BY sample_source, app_id, language, rid ORDER BY coalesce(updated, created) DESC) = 1""",
        "ingest_twice": f"""WITH {_RAW}, k AS (SELECT count(DISTINCT (sample_source, app_id, language, rid)) AS n FROM raw)
          SELECT n AS n_keys, n AS n_distinct, n AS n_first, CAST(0 AS BIGINT) AS n_second FROM k""",
        "ingest_names": f"""WITH {_RAW}, named AS (SELECT DISTINCT CASE sample_source WHEN 'natural' THEN 'natural' ELSE 'other flow = 50%+' END AS sample_source,
          app_id, CASE language WHEN 'spanish' THEN 'zh-Hans' ELSE language END AS language, rid FROM raw)
          SELECT sample_source, language, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_again FROM named GROUP BY ALL""",
        "raw_quarantine": f"""WITH {_RAW} SELECT * FROM (SELECT CASE WHEN votes_up % 2 <> 0 THEN 'outside the partition layout' WHEN votes_up % 7 = 0 THEN 'missing id'
          WHEN votes_up % 5 = 0 THEN 'missing creation time' WHEN votes_up % 3 = 0 THEN 'missing vote' END AS reason, count(*) AS n_rows
          FROM raw GROUP BY 1) WHERE reason IS NOT NULL""",
        "purge_files": """WITH d AS (SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1), m AS (SELECT *, max(dt) OVER () AS today FROM d)
          SELECT count(*) FILTER (dt < today - 20) AS n_removed, count(*) FILTER (dt >= today - 20) AS n_days,
          CAST(coalesce(sum(n) FILTER (dt >= today - 20), 0) AS BIGINT) AS n_rows FROM m""",
        "silver_dedup": f"WITH {_RAW}{_DEDUP} SELECT rid AS review_id, sample_source, source_file, updated FROM dedup",
        "pseudonymise": f"SELECT event_id, {_hmac('CAST(user_id AS VARCHAR)')} AS pseudo FROM events",
        "text_normalise": f"WITH {_RAW} SELECT rid AS review_id, source_file, md5({_clean('review')}) AS text_md5, "
        f"length({_clean('review')}) AS text_len FROM raw",
        "incremental_new_rows": f"""WITH {_RAW} SELECT DISTINCT sample_source, app_id, language, rid AS recommendationid
          FROM raw r WHERE NOT EXISTS (SELECT 1 FROM raw s WHERE s.votes_up >= 50 AND s.sample_source = r.sample_source
          AND s.app_id = r.app_id AND s.language = r.language AND s.rid = r.rid)""",
        "retention_partitions": """SELECT event_type AS source, CAST(ts AS DATE) AS dt, count(*) AS n_rows,
          CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events) - 20 AS expired FROM events GROUP BY ALL""",
        "flow_uniqueness": f"""WITH {_RAW} SELECT sample_source, count(*) AS n_rows, count(DISTINCT rid) AS n_ids,
          count(*) = count(DISTINCT rid) AS success FROM raw GROUP BY sample_source""",
        "quality_suite_silver": f"WITH {_GOLD} {_SUITES_SILVER}",
        "quality_suite_gold": f"WITH {_GOLD} {_SUITES_GOLD}",
        "quality_verdict": f"""WITH {_GOLD} SELECT suite, count(*) AS evaluated, count(*) FILTER (NOT success) AS failed,
          bool_and(success) AS success FROM ({_SUITES_SILVER} UNION ALL {_SUITES_GOLD}) GROUP BY suite""",
        "quality_gate": f"WITH {_SILVER} {_GATE}",
        "negative_share_gate": f"""WITH {_SILVER} SELECT count(*) AS n_natural, round(avg(1 - label), 6) AS negative_share,
          avg(1 - label) BETWEEN 0.005 AND 0.95 AS success FROM silver WHERE sample_source = 'natural'""",
        "status_histogram": f"""WITH {_GOLD} SELECT CASE WHEN success THEN 'pass' ELSE 'fail' END AS status, count(*) AS n
          FROM ({_SUITES_GOLD}) GROUP BY ALL""",
        "stg_reviews": f"""WITH {_SILVER} SELECT review_id, app_id, language, label, created_at,
          CAST(created_at AS DATE) AS review_date, updated_at, votes_up, round(weighted_vote_score, 6) AS weighted_vote_score,
          playtime_at_review_min, text_len, sample_source FROM silver_len""",
        "dim_date": f"""WITH {_SILVER} SELECT DISTINCT CAST(created_at AS DATE) AS date_day,
          CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month,
          CAST(week(created_at) AS INTEGER) AS iso_week, CAST(isodow(created_at) AS INTEGER) AS day_of_week FROM silver""",
        "dim_game": f"""WITH {_GOLD} SELECT g.app_id, g.game_name, count(s.review_id) AS n_reviews
          FROM games g LEFT JOIN silver s USING (app_id) GROUP BY ALL""",
        "fct_review_predictions": f"""WITH {_GOLD} SELECT * REPLACE (round(proba_negative, 6) AS proba_negative,
          round(decision_threshold, 6) AS decision_threshold) FROM fact""",
        "mart_sentiment_daily": f"""WITH {_GOLD} SELECT * REPLACE (round(share_pred_negative, 6) AS share_pred_negative,
          round(share_actual_negative, 6) AS share_actual_negative) FROM mart""",
        "unscored_reviews": f"WITH {_SILVER} SELECT review_id FROM silver WHERE votes_up <= 0",
        "fk_orphans": f"""WITH {_GOLD} SELECT 'fact.app_id' AS relation, CAST(app_id AS VARCHAR) AS value, count(*) AS n_rows
          FROM fact WHERE app_id NOT IN (SELECT app_id FROM games) GROUP BY ALL""",
        "mart_grain_duplicates": f"WITH {_GOLD} SELECT app_id, language, review_date FROM mart WHERE game_name LIKE 'Baldur%'",
        "range_anomalies": f"""WITH {_GOLD} SELECT round(share_pred_negative * 10, 6) AS anomaly FROM mart WHERE share_pred_negative * 10 > 1
          UNION ALL SELECT round(-share_actual_negative, 6) FROM mart WHERE share_actual_negative > 0""",
        "predict_batch": f"""WITH {_PRED} SELECT p.review_id, left(s.review_text, 80) AS preview, round(proba_negative, 6) AS proba_negative,
          CASE pred_label WHEN 0 THEN 'negative' ELSE 'positive' END AS label, '10' AS model_version, decision_threshold
          FROM pred p JOIN silver s USING (review_id)""",
        "valid_requests": "SELECT doc_id, length(text) BETWEEN 1 AND 5000 AS valid FROM documents",
        "daily_summary": f"WITH {_GOLD} SELECT date, {_SUMMARY_COLUMNS} FROM summary",
        "insights_last_days": f"""WITH {_GOLD} SELECT strftime(date, '%Y-%m-%d') AS date, {_SUMMARY_COLUMNS}
          FROM (SELECT *, max(date) OVER (PARTITION BY app_id) AS latest FROM summary) WHERE date >= latest - 1""",
        "insights_one_app": f"""WITH {_GOLD} SELECT strftime(date, '%Y-%m-%d') AS date, {_SUMMARY_COLUMNS}
          FROM summary WHERE app_id = 1086940 AND date >= (SELECT max(date) FROM summary WHERE app_id = 1086940) - 1""",
        "dashboard_kpis": f"""WITH {_PRED} SELECT count(*) AS n_reviews, round(coalesce(avg(1 - pred_label), 0), 6) AS share_pred_negative,
          round(coalesce(avg(1 - label), 0), 6) AS share_actual_negative, coalesce(min(model_version), 'N/A') AS model_version,
          CASE WHEN count(*) > 0 THEN CAST(0.6 AS DOUBLE) ELSE 0.5 END AS decision_threshold
          FROM pred WHERE sample_source = 'natural' AND app_id = 1086940 AND language = 'english'""",
        "daily_share_series": f"""WITH {_GOLD} SELECT date, round(share_negative_pred, 6) AS share_negative_pred,
          round(share_negative_true, 6) AS share_negative_true FROM summary WHERE app_id = 1086940 AND language = 'english'""",
        "dashboard_filter_values": f"""WITH {_SILVER} SELECT DISTINCT 'app_id' AS "filter", CAST(app_id AS VARCHAR) AS value
          FROM silver WHERE sample_source = 'natural'
          UNION ALL SELECT DISTINCT 'language', language FROM silver WHERE sample_source = 'natural'""",
        "top_negative_reviews": f"""WITH {_PRED} SELECT review_id,
          CASE WHEN length(review_text) > 200 THEN left(review_text, 200) || '…' ELSE review_text END AS text,
          round(proba_negative, 9) AS proba_negative, strftime(p.created_at, '%Y-%m-%d') AS date
          FROM pred p JOIN silver s USING (review_id)
          WHERE p.sample_source = 'natural' AND p.app_id = 1086940 AND p.language = 'english'
          ORDER BY round(proba_negative, 9) DESC, review_id LIMIT 20""",
        "scored_counts": f"""WITH {_PRED} SELECT p.label, p.pred_label, count(*) AS n_reviews,
          CAST(sum(length(s.review_text)) AS BIGINT) AS n_chars FROM silver s JOIN pred p USING (review_id) GROUP BY ALL""",
        "service_state": f"""WITH {_RUNS},
          best AS (SELECT min(run_id) AS run_id, CAST(day - DATE '2020-01-01' AS BIGINT) AS version FROM runs GROUP BY day)
          SELECT version, round(coalesce(CASE WHEN f1_macro >= 0.5 THEN f1_macro END, 0.5), 6) AS threshold
          FROM (SELECT version FROM aliases WHERE alias = 'champion') JOIN best USING (version) JOIN runs USING (run_id)""",
        "label_names": f"""WITH {_SILVER} SELECT CASE label WHEN 0 THEN 'negative' ELSE 'positive' END AS label_name,
          count(*) AS n_reviews FROM silver GROUP BY ALL""",
        "chrono_halves": f"WITH {_HALVES} SELECT review_id, half FROM halves",
        "psi_numeric": f'WITH {_HALVES}{_PSI} SELECT "column", round(psi, 6) AS psi FROM psi_num',
        "psi_categorical": f'WITH {_HALVES}{_PSI} SELECT "column", round(psi, 6) AS psi FROM psi_cat',
        "input_drift": f'WITH {_HALVES}{_PSI} SELECT "column", round(psi, 6) AS psi, interpretation FROM psi_all',
        "prediction_drift": f"WITH {_GOLD}{_RATIOS} SELECT * REPLACE (round(ratio, 6) AS ratio) FROM ratios",
        "drift_verdict": f"""WITH {_GOLD}{_RATIOS}, {_HALVES.replace(_SILVER + ',', '')}{_PSI},
          v AS (SELECT psi AS psi_max, (SELECT coalesce(avg(CAST(out_of_bounds AS INTEGER)), 0) FROM ratios) AS share FROM psi_num)
          SELECT psi_max >= 0.2 OR share > 0.1 AS alert,
            concat_ws('; ', CASE WHEN psi_max >= 0.2 THEN printf('maximal PSI %.3f reaches the alert level 0.200', psi_max) END,
              CASE WHEN share > 0.1 THEN printf('share out of bounds %.2f%% exceeds 10.00%%', share * 100) END) AS reasons,
            round(psi_max, 6) AS psi_max, 'text_len' AS psi_max_column, round(share, 6) AS share_out_of_bounds,
            'text_len' AS watched FROM v""",
        "term_stats": f"WITH {_TERMS} SELECT term, df, cf FROM stats",
        "frequent_terms": f"WITH {_TERMS} SELECT term, df, cf FROM stats ORDER BY cf DESC, sha256(term) LIMIT 500",
        "word_bigrams": f"""WITH {_SILVER},
          lists AS (SELECT review_id, regexp_extract_all(lower(review_text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws FROM silver),
          numbered AS (SELECT review_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM lists),
          grams AS (SELECT review_id, w AS g FROM numbered UNION ALL
            SELECT a.review_id, a.w || ' ' || b.w FROM numbered a JOIN numbered b ON a.review_id = b.review_id AND b.i = a.i + 1)
          SELECT s.review_id, count(g) AS n_terms, count(DISTINCT g) AS n_distinct FROM silver s LEFT JOIN grams USING (review_id) GROUP BY s.review_id""",
        "char_ngrams": f"""WITH {_SILVER},
          pieces AS (SELECT review_id, ' ' || unnest(regexp_split_to_array(lower(review_text), ' ')) || ' ' AS p FROM silver),
          sized AS (SELECT review_id, p, unnest(range(2, least(5, length(p)) + 1)) AS n FROM pieces WHERE length(p) > 2),
          placed AS (SELECT review_id, p, n, unnest(range(1, length(p) - n + 2)) AS i FROM sized),
          grams AS (SELECT review_id, substring(p, i, n) AS g, count(*) AS tf FROM placed GROUP BY ALL)
          SELECT s.review_id, CAST(coalesce(sum(tf), 0) AS BIGINT) AS n_terms, count(g) AS n_distinct
          FROM silver s LEFT JOIN grams USING (review_id) GROUP BY s.review_id""",
        "tfidf_words": f"""WITH {_TERMS},{_weights()} SELECT review_id, term,
          round(raw_w / sqrt(sum(raw_w * raw_w) OVER (PARTITION BY review_id)), 6) AS tfidf FROM weighted""",
        "class_weights": f"""WITH {_SILVER} SELECT label, count(*) AS n_rows,
          round((SELECT count(*) FROM silver) / (SELECT count(DISTINCT label) FROM silver) / count(*), 6) AS weight
          FROM silver GROUP BY label""",
        "stratified_holdout": f"""WITH {_SILVER} SELECT review_id, label, CASE WHEN rk <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split
          FROM ({_NATURAL_RANK})""",
        "stratified_fold_numbers": f"""WITH {_SILVER} SELECT review_id, label, CAST((rk > n * 1 // 5)::INT + (rk > n * 2 // 5)::INT
          + (rk > n * 3 // 5)::INT + (rk > n * 4 // 5)::INT AS INTEGER) AS fold FROM ({_NATURAL_RANK})""",
        "threshold_curve": f"WITH {_CURVE} SELECT threshold, round(f1_macro, 6) AS f1_macro FROM curve",
        "threshold_search": f"""WITH {_CURVE} SELECT threshold, round(f1_macro, 6) AS f1_macro FROM curve
          ORDER BY round(f1_macro, 9) DESC, round(abs(threshold - 0.5), 9), threshold LIMIT 1""",
        "classification_metrics": f"""WITH {_PRED}, c AS ({_confusion()} FROM pred) SELECT n_rows, round({_F1}, 6) AS f1_macro,
          round({_RECALL}, 6) AS recall_negative, round({_PRECISION}, 6) AS precision_negative FROM c""",
        "metrics_per_group": f"""WITH {_PRED}, c AS ({_confusion('app_id, language,')} FROM pred GROUP BY app_id, language)
          SELECT app_id, language, n_rows, round({_F1}, 6) AS f1_macro, round({_RECALL}, 6) AS recall_negative,
          round({_PRECISION}, 6) AS precision_negative FROM c""",
        "roc_auc": f"""WITH {_PRED}, p AS (SELECT label, round(proba_negative, 9) AS s FROM pred),
          r AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS rk FROM p),
          t AS (SELECT count(*) FILTER (label = 0) AS n_neg, count(*) FILTER (label = 1) AS n_pos, sum(rk) FILTER (label = 0) AS total FROM r)
          SELECT n_neg, n_pos, round((total - n_neg * (n_neg + 1) / 2) / (n_neg * n_pos), 6) AS roc_auc FROM t""",
        "dataset_fingerprint": f"""WITH {_SILVER} SELECT count(*) AS data_rows, min(created_at) AS data_first_review,
          max(created_at) AS data_last_review, count(*) FILTER (sample_source = 'natural') AS data_natural_rows,
          count(*) FILTER (sample_source = 'negative_boost') AS data_boost_rows,
          CAST(sum(CAST(('0x' || substr(sha256(review_id || '|' || label || '|' || epoch_us(created_at) || '|' || review_text), 1, 15)) AS BIGINT)) AS VARCHAR)
            AS data_hash FROM silver""",
        "logreg_train": f"""WITH {_SILVER}, ranked AS (SELECT label, rk <= round(0.2 * n) AS test FROM ({_NATURAL_RANK}))
          SELECT (SELECT count(*) FILTER (NOT test) FROM ranked) + count(*) FILTER (sample_source = 'negative_boost') AS n_train,
          (SELECT count(*) FILTER (test) FROM ranked) AS n_test,
          round((SELECT count(*) FILTER (test AND label = 0) / count(*) FILTER (test) FROM ranked), 6) AS negative_share,
          count(*) AS data_rows, count(*) FILTER (sample_source = 'natural') AS data_natural_rows,
          count(*) FILTER (sample_source = 'negative_boost') AS data_boost_rows, min(created_at) AS data_first_review,
          max(created_at) AS data_last_review, true AS converged, true AS beats_chance FROM silver""",
        "hyperparameter_grid": """SELECT 'C=' || c || ' ngram=' || g || ' features=' || f AS candidate, CAST(5 AS BIGINT) AS n_folds, true AS above_floor
          FROM (SELECT unnest(['1', '4', '10']) AS c), (SELECT unnest(['2-4', '2-5']) AS g), (SELECT unnest(['50000', '100000']) AS f)""",
        "model_bench": """SELECT unnest(['logistic_char', 'linear_svm', 'ridge', 'complement_bayes', 'logistic_word', 'random_forest',
          'boosted_trees']) AS candidate, CAST(5 AS BIGINT) AS n_folds, true AS above_floor""",
        "promotion_history": f"""WITH {_RUNS} SELECT run_id, app_id, day, round(f1_macro, 6) AS f1_macro,
          round(train_test_gap, 6) AS train_test_gap, round(champion_f1, 6) AS champion_f1, promoted FROM history""",
        "alias_current": f"WITH {_RUNS} SELECT alias, version FROM aliases",
        "versions_with_metrics": f"""WITH {_RUNS},
          versions AS (SELECT CAST(day - DATE '2020-01-01' AS BIGINT) AS version, run_id, CAST(day - DATE '2020-01-01' AS BIGINT) * 1000 AS created_ms FROM runs
            UNION ALL SELECT CAST(day - DATE '2020-01-01' AS BIGINT) + 1000, 'missing', CAST(day - DATE '2020-01-01' AS BIGINT) * 1000 + 5 FROM runs),
          named AS (SELECT version, string_agg(alias, ',' ORDER BY alias) AS aliases FROM aliases GROUP BY version)
          SELECT version, created_ms, round(f1_macro, 6) AS f1_macro, round(train_test_gap, 6) AS train_test_gap,
          coalesce(aliases, '') AS aliases FROM versions
          LEFT JOIN runs USING (run_id) LEFT JOIN named USING (version)""",
        "candidate_ranking": f"""WITH {_RUNS},
          st AS (SELECT CAST(app_id AS VARCHAR) AS candidate, count(f1_macro) AS n_folds, avg(f1_macro) AS f1_mean,
            stddev_pop(f1_macro) AS f1_std FROM runs GROUP BY ALL),
          me AS (SELECT * FROM st WHERE candidate = '1086940')
          SELECT candidate, n_folds, round(f1_mean, 6) AS f1_mean, round(f1_std, 6) AS f1_std,
            round(f1_mean - (SELECT f1_mean FROM me), 6) AS gap,
            abs(f1_mean - (SELECT f1_mean FROM me)) >= (SELECT f1_std FROM me) AS significant FROM st""",
        "local_contributions": f"""WITH {_TERMS},{_local('model', 10)} SELECT review_id, rank, term, round(contribution, 6) AS contribution FROM top_terms""",
        "contribution_sums": f"""WITH {_PRED} SELECT s.review_id, coalesce(k, 0) AS n_terms, round(coalesce(margin, 0), 6) AS margin
          FROM silver s LEFT JOIN dots USING (review_id)
          LEFT JOIN (SELECT review_id, count(*) AS k FROM weighted GROUP BY review_id) USING (review_id)""",
        "global_terms": f"WITH {_TERMS} SELECT direction, term, round(weight, 6) AS weight FROM ({_GLOBAL.format(n=20)})",
        "extreme_coefficients": f"""WITH {_TERMS} SELECT term, round(coefficient, 6) AS coefficient, "end" FROM (
          SELECT * FROM (SELECT term, -coef_neg AS coefficient, 'negative' AS "end" FROM stable ORDER BY coefficient, term LIMIT 20)
          UNION ALL
          SELECT * FROM (SELECT term, -coef_neg AS coefficient, 'positive' AS "end" FROM stable ORDER BY coefficient DESC, term LIMIT 20))""",
        "explanation": f"""WITH {_TERMS},{_local('stable', 5)} SELECT 'local' AS scope, review_id, rank, term,
          round(contribution, 6) AS weight FROM top_terms
          UNION ALL SELECT 'global_' || direction, NULL, CAST(row_number() OVER (PARTITION BY direction ORDER BY weight DESC, term) AS INTEGER),
          term, round(weight, 6) FROM ({_GLOBAL.format(n=10)})""",
        "recent_samples": """SELECT event_type AS path, event_id AS request_id FROM events
          QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 500""",
        "endpoint_latency": """WITH r AS (SELECT * FROM events
          QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 2048),
          q AS (SELECT event_type, count(*) AS retained, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95,
            quantile_cont(value, 0.99) AS p99, avg(value) AS mean, max(value) AS mx FROM r GROUP BY event_type)
          SELECT event_type AS path, total, retained, round(p50, 3) AS p50, round(p95, 3) AS p95, round(p99, 3) AS p99,
            round(mean, 3) AS mean, round(mx, 3) AS max
          FROM q JOIN (SELECT event_type, count(*) AS total FROM events GROUP BY event_type) USING (event_type)""",
        "load_summary": """WITH o AS (SELECT value, row_number() OVER (ORDER BY value) AS rk, count(*) OVER () AS n FROM events),
          t AS (SELECT count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok, avg(value) AS mean, max(value) AS mx,
            (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS secs FROM events)
          SELECT n AS requests, ok AS succeeded, n - ok AS failed, round((n - ok) / n, 6) AS error_rate,
            round(n / secs, 6) AS throughput, (SELECT value FROM o WHERE rk = (n * 50 + 99) // 100) AS p50,
            (SELECT value FROM o WHERE rk = (n * 90 + 99) // 100) AS p90,
            (SELECT value FROM o WHERE rk = (n * 99 + 99) // 100) AS p99, round(mean, 6) AS mean, mx AS max FROM t""",
        "ratio_by_group": f"""WITH {_PRED} SELECT app_id, language, round(p / t, 6) AS ratio, p / t BETWEEN 0.5 AND 2.0 AS success
          FROM (SELECT app_id, language, count(*) FILTER (pred_label = 0) AS p, count(*) FILTER (label = 0) AS t
                FROM pred WHERE sample_source = 'natural' GROUP BY ALL) WHERE t >= 2""",
        "zone_reconciliation": f"""WITH {_GOLD}, x AS (
          SELECT 'clean_vs_scored' AS "check", (SELECT count(*) FROM silver) AS left_count, (SELECT count(*) FROM pred) AS right_count
          UNION ALL SELECT 'scored_vs_fact', (SELECT count(*) FROM pred), (SELECT count(*) FROM fact)
          UNION ALL SELECT 'scored_vs_fact_natural', (SELECT count(*) FROM pred WHERE sample_source = 'natural'),
            (SELECT count(*) FROM fact WHERE sample_source = 'natural')
          UNION ALL SELECT 'summary_vs_natural', (SELECT CAST(sum(n_reviews) AS BIGINT) FROM summary),
            (SELECT count(*) FROM pred WHERE sample_source = 'natural')
          UNION ALL SELECT 'mart_not_empty', (SELECT least(count(*), 1) FROM mart), CAST(1 AS BIGINT))
          SELECT *, left_count = right_count AS success FROM x""",
        "version_mismatches": f"WITH {_PRED} SELECT count(*) AS n_rows, count(*) FILTER (model_version <> '10') AS mismatches FROM pred",
    }
    sql["endpoint_latency_stream"] = sql["endpoint_latency"]
    return sql
