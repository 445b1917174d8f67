"""SQL for the rating regression queries."""

from __future__ import annotations

from oracle.spam import ALL_REVIEWS, REVIEWS, rank

WORDS = r"regexp_extract_all(lower({col}), '[\p{{L}}\p{{N}}_]{{2,}}')"

SPLIT = f"""{REVIEWS},
ranked AS ({rank('reviews', 'doc_id', 2021)}),
split AS (SELECT doc_id, review, summary, overall, n_chars, rk < CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT) AS is_train FROM ranked)"""

IDF = f"""{SPLIT},
tf AS (SELECT doc_id, is_train, token, count(*) AS m FROM
  (SELECT doc_id, is_train, unnest({WORDS.format(col='review')}) AS token FROM split) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf WHERE is_train GROUP BY token),
idf AS (SELECT token, df, ln((1 + (SELECT count(*) FROM split WHERE is_train))::DOUBLE / (1 + df)) + 1 AS idf FROM df)"""


def bootstrap(src: str, models: int = 5, ratio: str = "0.8") -> str:
    """``draws(model_id, doc_id, multiplicity)`` from the table ``src``."""
    return f"""base AS ({rank(src, 'doc_id', 2021, 'doc_id')}),
drawn AS (SELECT model_id, j, CAST('0x' || substr(md5(concat(model_id, ':', j, ':2021')), 1, 15) AS BIGINT)
    % (SELECT count(*) FROM {src}) AS pick
  FROM (SELECT unnest(range({models})) AS model_id),
       (SELECT unnest(range(CAST(floor((SELECT count(*) FROM {src}) * CAST({ratio} AS DOUBLE)) AS BIGINT))) AS j)),
draws AS (SELECT CAST(d.model_id AS INTEGER) AS model_id, b.doc_id, count(*) AS multiplicity
  FROM drawn d JOIN base b ON b.rk = d.pick GROUP BY ALL)"""


def weighted_draws(name: str, weights: str, salt: int) -> str:
    """``name(doc_id, multiplicity)`` from ``weights(doc_id, w)``."""
    return f"""{name}_u AS (SELECT doc_id, rk, n,
    greatest(CAST(floor(w * CAST(576460752303423488 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT), CASE WHEN w > 0 THEN 1 ELSE 0 END) AS units
  FROM ({rank(weights, 'doc_id', 2021)})),
{name}_c AS (SELECT doc_id, n, CAST(sum(units) OVER (ORDER BY rk) - units AS BIGINT) AS lo,
  CAST(sum(units) OVER (ORDER BY rk) AS BIGINT) AS hi, CAST(sum(units) OVER () AS BIGINT) AS total FROM {name}_u),
{name}_d AS (SELECT CAST('0x' || substr(md5(concat({salt}, ':', j, ':2021')), 1, 15) AS BIGINT) % (SELECT max(total) FROM {name}_c) AS u
  FROM (SELECT unnest(range(CAST(floor((SELECT max(n) FROM {name}_c) * CAST(0.8 AS DOUBLE)) AS BIGINT))) AS j)),
{name} AS (SELECT c.doc_id, count(*) AS multiplicity FROM {name}_d d JOIN {name}_c c ON d.u >= c.lo AND d.u < c.hi GROUP BY c.doc_id)"""


LINES = f"""{SPLIT},
train AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, CAST(overall AS DOUBLE) AS y FROM split WHERE is_train),
test AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, CAST(overall AS DOUBLE) AS y FROM split WHERE NOT is_train)"""


def line(draws: str, key: str) -> str:
    """Least squares per ``key`` over ``draws``."""
    return f"""SELECT {key} AS model_id, slope, (sy - slope * sx) / n AS intercept FROM (
  SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM (
    SELECT {key}, CAST(sum(multiplicity) AS DOUBLE) AS n, sum(multiplicity * x) AS sx, sum(multiplicity * y) AS sy,
           sum(multiplicity * x * y) AS sxy, sum(multiplicity * x * x) AS sxx
    FROM {draws} d JOIN train t ON t.doc_id = d.doc_id GROUP BY {key}))"""


BAGGED = f"""{LINES},
{bootstrap('train')},
models AS ({line('draws', 'model_id')}),
preds AS (SELECT t.doc_id, m.model_id, m.slope * t.x + m.intercept AS pred, t.y FROM test t, models m),
mean AS (SELECT doc_id, y, avg(pred) AS pred FROM preds GROUP BY ALL)"""


def boosted(rounds: int) -> str:
    parts = [LINES, "w0 AS (SELECT doc_id, CAST(1 AS DOUBLE) / (SELECT count(*) FROM train) AS w FROM train)"]
    for i in range(rounds):
        parts.append(weighted_draws(f"draw{i}", f"w{i}", i))
        parts.append(f"model{i} AS ({line(f'(SELECT {i} AS k, * FROM draw{i})', 'k')})")
        parts.append(
            f"""gap{i} AS (SELECT d.doc_id, d.multiplicity, w.w, abs(m.slope * t.x + m.intercept - t.y) AS g
  FROM draw{i} d JOIN train t ON t.doc_id = d.doc_id JOIN w{i} w ON w.doc_id = d.doc_id, model{i} m),
loss{i} AS (SELECT doc_id, multiplicity, w, g / max(g) OVER () AS loss FROM gap{i}),
err{i} AS (SELECT sum(multiplicity * w * loss) AS error FROM loss{i}),
raw{i} AS (SELECT w.doc_id, CASE WHEN l.doc_id IS NULL THEN w.w ELSE w.w * pow(error / (1 - error), 1 - l.loss) END AS w
  FROM w{i} w LEFT JOIN loss{i} l ON l.doc_id = w.doc_id, err{i}),
w{i + 1} AS (SELECT doc_id, w / sum(w) OVER () AS w FROM raw{i})"""
        )
    models = " UNION ALL ".join(
        f"SELECT {i} AS model_id, slope, intercept, error, ln((1 - error) / error) AS weight FROM model{i}, err{i}" for i in range(rounds)
    )
    parts.append(f"models AS ({models})")
    return ",\n".join(parts)


VOTES = f"""{boosted(3)},
votes AS (SELECT t.doc_id, m.model_id, m.slope * t.x + m.intercept AS pred, m.weight FROM test t, models m),
cum AS (SELECT doc_id, pred, sum(weight) OVER (PARTITION BY doc_id ORDER BY pred, model_id) AS c,
        sum(weight) OVER (PARTITION BY doc_id) AS a FROM votes)"""

CELLS = f"""{IDF},
cells AS MATERIALIZED (SELECT doc_id, token, least(greatest(CAST(ceil(round(m * idf / norm * 64, 6)) AS INTEGER), 1), 64) AS step
  FROM (SELECT tf.*, idf, sqrt(sum(m * idf * m * idf) OVER (PARTITION BY doc_id)) AS norm FROM tf JOIN idf ON idf.token = tf.token)),
rated AS (SELECT doc_id, is_train, CAST(overall AS DOUBLE) AS y FROM split)"""


def trees(name: str, draws: str, depth: int) -> str:
    """``name(model_id, doc_id, fit, y, pred)``: trees grown level by level on ``draws(model_id, doc_id, multiplicity)``.

    Test reviews walk along without a weight.
    """
    parts = [
        f"""{name}_at0 AS MATERIALIZED (
  SELECT model_id, doc_id, TRUE AS fit, y, CAST(multiplicity AS DOUBLE) AS m, CAST(1 AS BIGINT) AS node, TRUE AS open, CAST(NULL AS DOUBLE) AS pred
  FROM {draws} JOIN rated USING (doc_id)
  UNION ALL SELECT model_id, doc_id, FALSE, y, 0, 1, TRUE, NULL FROM rated, (SELECT DISTINCT model_id FROM {draws}) WHERE NOT is_train)"""
    ]
    for i in range(depth + 1):
        at, whole, right, best = (f"{name}_{part}{i}" for part in ("at", "whole", "right", "best"))
        parts.append(
            f"""{whole} AS MATERIALIZED (SELECT model_id, node, sum(m) AS n, sum(m * y) AS s, min(y) < max(y) AS mixed FROM {at} WHERE fit AND open
  GROUP BY model_id, node),
{right} AS (SELECT model_id, node, token, step, sum(sum(m)) OVER above AS nr, sum(sum(m * y)) OVER above AS sr
  FROM {at} a JOIN cells c ON c.doc_id = a.doc_id WHERE a.fit AND open GROUP BY model_id, node, token, step
  WINDOW above AS (PARTITION BY model_id, node, token ORDER BY step DESC)),
{best} AS MATERIALIZED (SELECT model_id, node, token, step FROM {right} JOIN {whole} USING (model_id, node) WHERE mixed AND nr < n AND {i} < {depth}
  QUALIFY row_number() OVER (PARTITION BY model_id, node ORDER BY sr * sr / nr + (s - sr) * (s - sr) / (n - nr) DESC, token, step) = 1),
{name}_at{i + 1} AS MATERIALIZED (SELECT a.model_id, a.doc_id, a.fit, a.y, a.m, a.open AND b.node IS NOT NULL AS open,
    CASE WHEN a.open THEN s / n ELSE a.pred END AS pred,
    CASE WHEN a.open AND b.node IS NOT NULL THEN 2 * a.node + CASE WHEN c.step >= b.step THEN 1 ELSE 0 END ELSE a.node END AS node
  FROM {at} a LEFT JOIN {whole} w ON w.model_id = a.model_id AND w.node = a.node
  LEFT JOIN {best} b ON b.model_id = a.model_id AND b.node = a.node LEFT JOIN cells c ON c.doc_id = a.doc_id AND c.token = b.token)"""
        )
    parts.append(f"{name} AS (SELECT model_id, doc_id, fit, y, pred FROM {name}_at{depth + 1})")
    return ",\n".join(parts)


# Documents without a label walk along with the test reviews.
UNRATED = "unrated AS (SELECT doc_id, text AS review FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"
NEW_CELLS = f"""{IDF}, {UNRATED},
known AS (SELECT * FROM tf UNION ALL SELECT doc_id, FALSE, token, count(*) FROM
  (SELECT doc_id, unnest({WORDS.format(col='review')}) AS token FROM unrated) GROUP BY ALL),
cells AS MATERIALIZED (SELECT doc_id, token, least(greatest(CAST(ceil(round(m * idf / norm * 64, 6)) AS INTEGER), 1), 64) AS step
  FROM (SELECT k.*, idf, sqrt(sum(m * idf * m * idf) OVER (PARTITION BY doc_id)) AS norm FROM known k JOIN idf ON idf.token = k.token)),
rated AS (SELECT doc_id, is_train, CAST(overall AS DOUBLE) AS y FROM split UNION ALL SELECT doc_id, FALSE, NULL FROM unrated)"""

DEPTH, BOOST_DEPTH = 20, 4
TRAIN = "train AS (SELECT doc_id FROM rated WHERE is_train)"


def boosted_trees(rounds: int, cells: str = CELLS) -> str:
    """``kept(doc_id, model_id, pred, weight)``: test predictions and votes of the rounds before the first failing one."""
    parts = [cells, TRAIN, "w0 AS (SELECT doc_id, CAST(1 AS DOUBLE) / (SELECT count(*) FROM train) AS w FROM train)"]
    for i in range(rounds):
        parts.append(weighted_draws(f"draw{i}", f"w{i}", i))
        parts.append(f"sample{i} AS (SELECT {i} AS model_id, * FROM draw{i})")
        parts.append(trees(f"tree{i}", f"sample{i}", BOOST_DEPTH))
        parts.append(
            f"""loss{i} AS MATERIALIZED (SELECT t.doc_id, multiplicity, w, coalesce(abs(pred - y) / nullif(max(abs(pred - y)) OVER (), 0), 0) AS loss
  FROM tree{i} t JOIN draw{i} d USING (doc_id) JOIN w{i} w USING (doc_id) WHERE fit),
err{i} AS MATERIALIZED (SELECT {i} AS model_id, sum(multiplicity * w * loss) AS error FROM loss{i}),
raw{i} AS (SELECT w.doc_id, CASE WHEN l.doc_id IS NULL THEN w.w ELSE w.w * pow(error / (1 - error), 1 - l.loss) END AS w
  FROM w{i} w LEFT JOIN loss{i} l ON l.doc_id = w.doc_id, err{i}),
w{i + 1} AS MATERIALIZED (SELECT doc_id, w / sum(w) OVER () AS w FROM raw{i})"""
        )
    errors = " UNION ALL ".join(f"SELECT * FROM err{i}" for i in range(rounds))
    preds = " UNION ALL ".join(f"SELECT * FROM tree{i} WHERE NOT fit" for i in range(rounds))
    parts.append(
        f"""errors AS ({errors}),
judged AS (SELECT *, coalesce(error > 0 AND error < 0.5, FALSE) AS good FROM errors),
votes AS (SELECT model_id, CASE WHEN good THEN ln((1 - error) / error) ELSE 1 END AS weight FROM judged j
  WHERE (good OR model_id = 0) AND NOT EXISTS (SELECT 1 FROM judged e WHERE e.model_id < j.model_id AND NOT e.good)),
kept AS (SELECT p.doc_id, p.model_id, p.pred, v.weight FROM ({preds}) p JOIN votes v USING (model_id))"""
    )
    return ",\n".join(parts)


MEDIANS = """cum AS (SELECT doc_id, pred, sum(weight) OVER (PARTITION BY doc_id ORDER BY pred, model_id) AS c,
  sum(weight) OVER (PARTITION BY doc_id) AS a FROM kept),
medians AS (SELECT doc_id, round(min(pred), 6) AS pred FROM cum WHERE c >= 0.5 * a GROUP BY doc_id)"""

FLAT = r"regexp_replace({col}, '\s+', ' ', 'g')"
EMPTY = "CAST(NULL AS VARCHAR)"

SQL = {
    "tfidf_tokens": f"""SELECT token, count(*) AS n FROM (SELECT unnest({WORDS.format(col='text')}) AS token FROM documents)
      GROUP BY token""",
    "idf": f"WITH {IDF} SELECT token, df, round(idf, 9) AS idf FROM idf",
    "tfidf": f"""WITH {IDF} SELECT doc_id, is_train, tf.token, round(m * idf / sqrt(sum(m * idf * m * idf) OVER (PARTITION BY doc_id)), 9) AS w
      FROM tf JOIN idf ON idf.token = tf.token""",
    "rating_cast": f"WITH {REVIEWS} SELECT doc_id, CAST(overall AS DOUBLE) AS rating FROM reviews",
    "bootstrap": f"WITH {bootstrap('documents')} SELECT model_id, doc_id, multiplicity FROM draws",
    "bootstrap_rows": f"""WITH {REVIEWS}, {bootstrap('reviews')}
      SELECT d.model_id, d.doc_id, r.overall, CAST(unnest(range(1, d.multiplicity + 1)) AS INTEGER) AS copy
      FROM draws d JOIN reviews r ON r.doc_id = d.doc_id""",
    "weighted_draw": f"""WITH w AS (SELECT doc_id, CAST(n_chars AS DOUBLE) / CAST(sum(n_chars) OVER () AS DOUBLE) AS w FROM documents),
      {weighted_draws('hits', 'w', 0)} SELECT doc_id, multiplicity FROM hits""",
    "bagging_ols": f"WITH {BAGGED} SELECT model_id, round(slope, 9) AS slope, round(intercept, 6) AS intercept FROM models",
    "ensemble_mean": f"WITH {BAGGED} SELECT doc_id, round(pred, 6) AS pred FROM mean",
    "mae_rmse": f"WITH {BAGGED} SELECT round(avg(abs(y - pred)), 6) AS mae, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse FROM mean",
    "adaboost_ols": f"""WITH {boosted(3)} SELECT model_id, round(slope, 9) AS slope, round(intercept, 6) AS intercept,
      round(error, 6) AS error, round(weight, 6) AS weight FROM models WHERE error > 0 AND error < 0.5""",
    "boost_error": f"""WITH {boosted(1)} SELECT round(error, 6) AS error, round(error / (1 - error), 6) AS beta,
      round(weight, 6) AS weight FROM models""",
    "boost_reweight": f"WITH {boosted(1)} SELECT doc_id, round(w * 1000, 6) AS w FROM w1",
    "weighted_votes": f"WITH {VOTES} SELECT doc_id, model_id, round(pred, 6) AS pred, round(weight, 6) AS weight FROM votes",
    "weighted_median": f"WITH {VOTES} SELECT doc_id, round(min(pred), 6) AS pred FROM cum WHERE c >= 0.5 * a GROUP BY doc_id",
    "svr_certificate": f"""WITH {LINES}, {bootstrap('train')} SELECT model_id, CAST(sum(multiplicity) AS BIGINT) AS draws,
      count(*) AS reviews, TRUE AS bounded, TRUE AS settled FROM draws GROUP BY model_id""",
    "tree_regressor": f"""WITH {CELLS}, {TRAIN}, sole AS (SELECT 0 AS model_id, doc_id, 1 AS multiplicity FROM train),
      {trees('t', 'sole', DEPTH)} SELECT doc_id, y, pred FROM t WHERE NOT fit""",
    "bagging_trees": f"""WITH {CELLS}, {TRAIN}, {bootstrap('train')}, {trees('t', 'draws', DEPTH)}
      SELECT doc_id, y, round(avg(pred), 6) AS pred FROM t WHERE NOT fit GROUP BY doc_id, y""",
    "adaboost_trees": f"WITH {boosted_trees(3)}, {MEDIANS} SELECT doc_id, pred FROM medians",
    "predict_unlabelled": f"""WITH {boosted_trees(3, NEW_CELLS)}, {MEDIANS}
      SELECT row_number() OVER (ORDER BY doc_id) AS Id, pred AS Predicted FROM medians JOIN unrated USING (doc_id)""",
    "json_roundtrip": f"""WITH {ALL_REVIEWS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, overall, summary, md5(review) AS review_md5 FROM reviews""",
    "tsv_scan": f"""WITH {ALL_REVIEWS}, f AS (SELECT doc_id, {FLAT.format(col='review')} AS flat,
        trim({FLAT.format(col='summary')}) AS summary, overall FROM reviews),
      s AS (SELECT doc_id % 5 AS shape, CAST(doc_id AS VARCHAR) AS doc_id, flat, summary, overall FROM f)
      SELECT doc_id, md5(CASE shape WHEN 1 THEN rtrim(flat) WHEN 3 THEN 'short text' WHEN 4 THEN concat('"', flat) ELSE flat END) AS review_md5,
        CASE shape WHEN 1 THEN {EMPTY} WHEN 3 THEN {EMPTY} WHEN 4 THEN 'in "quotes"' ELSE summary END AS summary,
        CASE shape WHEN 1 THEN {EMPTY} WHEN 3 THEN {EMPTY} WHEN 4 THEN '5"' ELSE coalesce(overall, CASE shape WHEN 2 THEN '' END) END AS overall FROM s""",
    "metric_store": f"""WITH {BAGGED}, one AS ({line('(SELECT 0 AS k, doc_id, 1 AS multiplicity FROM train)', 'k')}),
      sole AS (SELECT t.y, o.slope * t.x + o.intercept AS pred FROM test t, one o),
      q AS (SELECT 'bagging' AS run, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM mean
        UNION ALL SELECT 'single', avg(abs(y - pred)), sqrt(avg((y - pred) * (y - pred))) FROM sole)
      SELECT run, unnest(['mae', 'rmse']) AS metric, unnest([round(mae, 6), round(rmse, 6)]) AS value FROM q""",
}
