"""SQL for the spam-filter queries."""

from __future__ import annotations

MAIL = """mail AS (
  SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'ham' ELSE 'spam' END AS label,
         concat('user', d.doc_id, '@', d.source, '.example>') AS sender, d.text AS body
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

REVIEWS = """reviews AS (
  SELECT d.doc_id, d.text AS review, split_part(d.text, chr(10), 1) AS summary,
         CAST(1 + 2 * l.quality + (1 - l.toxic) + d.n_chars % 2 AS VARCHAR) AS overall, d.n_chars
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

# The same with the documents that have no label.
ALL_MAIL, ALL_REVIEWS = (
    v.replace("JOIN labels", "LEFT JOIN labels").replace("ELSE 'spam'", "WHEN l.quality IS NOT NULL THEN 'spam'") for v in (MAIL, REVIEWS)
)


def kept(col: str) -> str:
    return rf"regexp_replace({col}, '[^\x00-\x7F]', '', 'g')"


def mail_tokens(col: str) -> str:
    return rf"regexp_extract_all({kept(col)}, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f\x0B]')"


def domain(col: str = "sender") -> str:
    return f"split_part(split_part({col}, '@', -1), '>', 1)"


def features(body: str = "body") -> str:
    return f"list_concat([{domain()}], {mail_tokens(body)})"


def rank(src: str, key: str, seed: int, cols: str = "*") -> str:
    return (
        f"SELECT {cols}, row_number() OVER (ORDER BY md5(concat({key}, ':{seed}')), {key}) - 1 AS rk, "
        f"count(*) OVER () AS n FROM {src}"
    )


SPLIT = f"""{MAIL},
ranked AS ({rank('mail', 'doc_id', 2021)}),
split AS (SELECT doc_id, label, sender, body, rk >= n - CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) AS is_test FROM ranked)"""

FOLDED = f"""{MAIL},
ranked AS ({rank('mail', 'doc_id', 2021)}),
sized AS (SELECT *, CAST(floor(n * (CAST(1 AS DOUBLE) / 5)) AS BIGINT) AS b FROM ranked),
folded AS (SELECT doc_id, label, sender, body, CASE WHEN rk < 5 * b THEN CAST(rk // b AS INTEGER) END AS fold FROM sized)"""


def bayes(runs: str, tokens: str) -> str:
    """Scores from ``runs(variant, doc_id, label, role)`` and ``toks(variant or none, doc_id, token)``."""
    return f"""runs AS ({runs}),
toks AS ({tokens}),
prior AS (SELECT variant, label, count(*) AS n FROM runs WHERE role = 'train' GROUP BY ALL),
prior_p AS (SELECT variant, label, n / sum(n) OVER (PARTITION BY variant) AS p FROM prior),
freq AS (SELECT r.variant, r.label, t.token, count(*) AS n FROM runs r JOIN toks t
         ON r.doc_id = t.doc_id AND (t.variant IS NULL OR t.variant = r.variant)
         WHERE r.role = 'train' GROUP BY ALL),
freq_p AS (SELECT variant, label, token, n, n / sum(n) OVER (PARTITION BY variant, label) AS p FROM freq),
tests AS (SELECT r.variant, r.doc_id, r.label, t.token, count(t.token) AS m FROM runs r LEFT JOIN toks t
          ON r.doc_id = t.doc_id AND (t.variant IS NULL OR t.variant = r.variant)
          WHERE r.role = 'test' GROUP BY ALL),
scores AS (SELECT t.variant, t.doc_id, t.label, p.label AS cls,
           ln(any_value(p.p)) + sum(t.m * ln(coalesce(f.p, 1e-10))) AS s
           FROM tests t JOIN prior_p p ON p.variant = t.variant
           LEFT JOIN freq_p f ON f.variant = t.variant AND f.label = p.label AND f.token = t.token
           GROUP BY ALL),
wide AS (SELECT variant, doc_id, label, max(CASE WHEN cls = 'ham' THEN s END) AS s_ham,
         max(CASE WHEN cls = 'spam' THEN s END) AS s_spam FROM scores GROUP BY ALL),
preds AS (SELECT variant, doc_id, CASE WHEN label = 'spam' THEN 1 ELSE 0 END AS label_id,
          CASE WHEN s_spam > s_ham THEN 1 ELSE 0 END AS pred FROM wide),
counts AS (SELECT variant, avg(CASE WHEN pred = label_id THEN 1.0 ELSE 0.0 END) AS accuracy,
           count(*) FILTER (pred = 1 AND label_id = 1) AS tp,
           count(*) FILTER (pred = 1 AND label_id = 0) AS fp,
           count(*) FILTER (pred = 0 AND label_id = 1) AS fn FROM preds GROUP BY variant),
pr AS (SELECT variant, accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM counts),
report AS (SELECT variant, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1,
           accuracy AS accuracy_x, precision AS precision_x, recall AS recall_x,
           CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_x FROM pr)"""


HOLDOUT_RUNS = "SELECT 'holdout' AS variant, doc_id, label, CASE WHEN is_test THEN 'test' ELSE 'train' END AS role FROM split"
TOKENS = "SELECT CAST(NULL AS VARCHAR) AS variant, doc_id, unnest({f}) AS token FROM {src}"
HOLDOUT = f"{SPLIT},\n{bayes(HOLDOUT_RUNS, TOKENS.format(f=features(), src='split'))}"

FOLD_RUNS = """SELECT CAST(i AS VARCHAR) AS variant, doc_id, label, CASE WHEN fold = i THEN 'test' ELSE 'train' END AS role
  FROM folded, (SELECT unnest(range(5)) AS i)"""
FOLDS = f"{FOLDED},\n{bayes(FOLD_RUNS, TOKENS.format(f=features(), src='folded'))}"

RATE_RUNS = """SELECT 'x' || rate AS variant, doc_id, label, 'train' AS role FROM
  (SELECT *, row_number() OVER (ORDER BY md5(concat(doc_id, ':2022')), doc_id) - 1 AS rk2, count(*) OVER () AS n2
   FROM split WHERE NOT is_test), (VALUES (CAST(0.05 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(1 AS DOUBLE))) v(rate)
  WHERE rk2 < CAST(floor(n2 * rate) AS BIGINT)
  UNION ALL SELECT 'x' || rate, doc_id, label, 'test' FROM split,
  (VALUES (CAST(0.05 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(1 AS DOUBLE))) v(rate) WHERE is_test"""
RATES = f"{SPLIT},\n{bayes(RATE_RUNS, TOKENS.format(f=features(), src='split'))}"

MODE_RUNS = """SELECT mode AS variant, doc_id, label, CASE WHEN is_test THEN 'test' ELSE 'train' END AS role
  FROM split, (VALUES ('domain'), ('full'), ('none')) v(mode)"""
MODE_TOKENS = f"""SELECT CAST(NULL AS VARCHAR) AS variant, doc_id, unnest({mail_tokens('body')}) AS token FROM split
  UNION ALL SELECT 'domain', doc_id, {domain()} FROM split
  UNION ALL SELECT 'full', doc_id, split_part(sender, '>', 1) FROM split"""
MODES = f"{SPLIT},\n{bayes(MODE_RUNS, MODE_TOKENS)}"

PAIRS = "pairs AS (SELECT toxic AS pred, 1 - quality AS label FROM labels)"
BINARY = f"""{PAIRS}, c AS (SELECT count(*) FILTER (pred = 1 AND label = 1) AS tp, count(*) FILTER (pred = 1 AND label <> 1) AS fp,
  count(*) FILTER (pred <> 1 AND label = 1) AS fn FROM pairs)"""

INGESTED = f"""WITH {ALL_MAIL}, m AS (
  SELECT concat('data/', doc_id) AS path, {domain()} AS sender,
         CASE doc_id % 4 WHEN 0 THEN body WHEN 1 THEN body WHEN 2 THEN concat('<p>', body, '</p>', body) ELSE '' END AS body
  FROM mail UNION ALL SELECT concat('pages/', page_id), '', html FROM pages)
  SELECT path, sender, CAST(length(body) AS INTEGER) AS n_chars, md5(body) AS body_md5 FROM m"""

SQL = {
    "src_label_index": f"WITH {MAIL} SELECT label, concat('data/', doc_id) AS path FROM mail",
    "mail_ingest": INGESTED,
    "mail_scan": INGESTED,
    "mail_faults": """WITH d AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id % 4 = 3) AS unknown FROM documents),
      p AS (SELECT count(*) AS n FROM pages)
      SELECT unnest(['messages', 'no_sender', 'charset', 'message', 'part']) AS counter,
        unnest([d.n + p.n, p.n, unknown, 0, 0]) AS n FROM d, p""",
    "index_join": f"""WITH {MAIL}, m AS (
      SELECT concat('data/', doc_id) AS path, label, sender,
             CASE doc_id % 4 WHEN 0 THEN body WHEN 1 THEN body WHEN 2 THEN concat('<p>', body, '</p>', body) ELSE '' END AS body
      FROM mail) SELECT path, label, CAST(len({features()}) AS INTEGER) AS n_features FROM m""",
    "sender_domain": f"""WITH {ALL_MAIL} SELECT doc_id, {domain()} AS domain, split_part(sender, '>', 1) AS full_address,
      '' AS no_sender FROM mail""",
    "ascii_filter": f"""SELECT doc_id, CAST(length({kept('text')}) AS INTEGER) AS n_kept, md5({kept('text')}) AS kept_md5
      FROM documents""",
    "word_tokens": f"SELECT token, count(*) AS n FROM (SELECT unnest({mail_tokens('text')}) AS token FROM documents) GROUP BY token",
    "mail_features": f"""WITH {ALL_MAIL}, f AS (SELECT doc_id, {features()} AS f FROM mail)
      SELECT doc_id, CAST(len(f) AS INTEGER) AS n_features, f[1] AS first_feature,
             md5(array_to_string(f, ' ')) AS features_md5 FROM f""",
    "label_index": f"WITH {MAIL} SELECT doc_id, label, CASE label WHEN 'ham' THEN 0 ELSE 1 END AS class_id FROM mail",
    "seeded_shuffle": f"SELECT doc_id, rk FROM ({rank('documents', 'doc_id', 2021)})",
    "sample_fraction": f"""SELECT doc_id, source FROM ({rank('documents', 'doc_id', 2021)})
      WHERE rk < CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT)""",
    "holdout_tail": f"WITH {SPLIT} SELECT doc_id, label, is_test FROM split",
    "holdout_head": f"""WITH {REVIEWS} SELECT doc_id, overall, rk < CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT) AS is_train
      FROM ({rank('reviews', 'doc_id', 2021)})""",
    "kfold_assign": f"""WITH r AS ({rank('documents', 'doc_id', 2021)}),
      s AS (SELECT *, CAST(floor(n * (CAST(1 AS DOUBLE) / 7)) AS BIGINT) AS b FROM r)
      SELECT doc_id, CASE WHEN rk < 7 * b THEN CAST(rk // b AS INTEGER) END AS fold FROM s""",
    "sample_rows": "SELECT doc_id, lang FROM documents ORDER BY md5(concat(doc_id, ':2021')), doc_id LIMIT 500",
    "kfold_write": f"WITH {FOLDED} SELECT doc_id, label, sender, CAST(length(body) AS INTEGER) AS n_chars, fold FROM folded",
    "fold_train_anti": f"""WITH {FOLDED} SELECT doc_id, label FROM folded
      EXCEPT SELECT doc_id, label FROM folded WHERE fold = 0""",
    "fold_train_union": f"WITH {FOLDED} SELECT doc_id, label FROM folded WHERE fold IS NULL OR fold <> 2",
    "label_freq": f"""WITH {MAIL} SELECT c.label, count(m.doc_id) AS n FROM (VALUES ('ham'), ('spam')) c(label)
      LEFT JOIN mail m ON m.label = c.label GROUP BY c.label""",
    "class_tokens": f"""WITH {MAIL}, f AS (SELECT doc_id, label, {features()} AS f FROM mail)
      SELECT doc_id, label, CAST(unnest(range(len(f))) AS INTEGER) AS pos, unnest(f) AS token FROM f""",
    "token_freq": f"""WITH {MAIL}, t AS (SELECT label, unnest({features()}) AS token FROM mail)
      SELECT token, count(*) FILTER (label = 'ham') AS n_ham, count(*) FILTER (label = 'spam') AS n_spam FROM t GROUP BY token""",
    "class_prior": f"""WITH {MAIL}, c AS (SELECT label, count(*) AS n FROM mail GROUP BY label)
      SELECT label, n, round(n / sum(n) OVER (), 9) AS p FROM c""",
    "cond_prob": f"""WITH {MAIL}, t AS (SELECT label, unnest({features()}) AS token FROM mail),
      f AS (SELECT token, count(*) FILTER (label = 'ham') AS h, count(*) FILTER (label = 'spam') AS s FROM t GROUP BY token)
      SELECT token, CASE WHEN h > 0 THEN round(h / sum(h) OVER (), 12) END AS p_ham,
             CASE WHEN s > 0 THEN round(s / sum(s) OVER (), 12) END AS p_spam FROM f""",
    "nb_params": f"""WITH {SPLIT}, t AS (SELECT label, unnest({features()}) AS token FROM split WHERE NOT is_test)
      SELECT token, count(*) FILTER (label = 'ham') AS n_ham, count(*) FILTER (label = 'spam') AS n_spam FROM t GROUP BY token
      UNION ALL SELECT NULL, count(*) FILTER (label = 'ham'), count(*) FILTER (label = 'spam') FROM split WHERE NOT is_test""",
    "nb_token_join": f"""WITH {HOLDOUT}
      SELECT t.doc_id, t.token, t.m, round(ln(coalesce(h.p, 1e-10)), 6) AS lp_ham, round(ln(coalesce(s.p, 1e-10)), 6) AS lp_spam
      FROM tests t LEFT JOIN freq_p h ON h.label = 'ham' AND h.token = t.token
      LEFT JOIN freq_p s ON s.label = 'spam' AND s.token = t.token WHERE t.token IS NOT NULL""",
    "nb_scores": f"WITH {HOLDOUT} SELECT doc_id, label, round(s_ham, 4) AS s_ham, round(s_spam, 4) AS s_spam FROM wide",
    "nb_predict": f"WITH {HOLDOUT} SELECT doc_id, label_id, pred FROM preds",
    "nb_metrics": f"WITH {HOLDOUT} SELECT accuracy, precision, recall, f1 FROM report",
    "nb_kfold": f"WITH {FOLDS} SELECT CAST(variant AS INTEGER) AS fold, accuracy, precision, recall, f1 FROM report",
    "fold_average": f"""WITH {FOLDS} SELECT unnest(['accuracy', 'precision', 'recall', 'f1']) AS metric,
      unnest([round(avg(accuracy_x), 6), round(avg(precision_x), 6), round(avg(recall_x), 6), round(avg(f1_x), 6)]) AS value
      FROM report""",
    "nb_rate_sweep": f"WITH {RATES} SELECT CAST(replace(variant, 'x', '') AS DOUBLE) AS rate, accuracy, precision, recall, f1 FROM report",
    "nb_sender_ablation": f"WITH {MODES} SELECT variant AS mode, accuracy, precision, recall, f1 FROM report",
    "pred_label_join": f"""WITH {HOLDOUT} SELECT p.doc_id, p.pred, 1 - l.quality AS label
      FROM preds p JOIN labels l ON l.doc_id = p.doc_id""",
    "accuracy": f"WITH {PAIRS} SELECT round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM pairs",
    "confusion_binary": f"WITH {BINARY} SELECT tp, fp, fn FROM c",
    "prf_binary": f"""WITH {BINARY}, q AS (SELECT coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)
      SELECT round(p, 9) AS precision, round(r, 9) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1 FROM q""",
}
