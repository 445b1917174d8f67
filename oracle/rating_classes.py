"""SQL for the rating classifier queries."""

from __future__ import annotations

from oracle.ratings import WORDS
from oracle.spam import ALL_REVIEWS, REVIEWS, rank

TOKENS = r"regexp_extract_all({col}, '\[SOS\]|[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_ \t\n\r\f\x0B]')"
TEXT = "concat(summary, '[SOS]', review)"

SPLIT = f"""{REVIEWS},
ranked AS ({rank('reviews', 'doc_id', 2021)}),
split AS (SELECT doc_id, review, summary, overall, {TEXT} AS text,
  rk >= n - CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) AS is_test FROM ranked)"""


def positions(limit: str = "") -> str:
    lists = f"{TOKENS.format(col='text')}{limit}"
    return f"""lists AS (SELECT doc_id, is_test, {lists} AS t FROM split),
pos AS (SELECT doc_id, is_test, unnest(range(len(t))) AS pos, unnest(t) AS token FROM lists)"""


IDS = f"""all_tokens AS (SELECT is_test, unnest({TOKENS.format(col='text')}) AS token FROM split),
freq AS (SELECT token, count(*) AS n FROM all_tokens WHERE NOT is_test GROUP BY token),
ids AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id FROM freq)"""

ENCODED = f"""{IDS}, enc AS (SELECT p.doc_id, p.pos, coalesce(i.token_id, 1) AS token_id FROM pos p LEFT JOIN ids i ON i.token = p.token)"""

PROBS = f"""{SPLIT},
tr AS (SELECT doc_id, overall, text,
  row_number() OVER (ORDER BY md5(concat(doc_id, ':2022')), doc_id) - 1 AS ra,
  row_number() OVER (ORDER BY md5(concat(doc_id, ':2023')), doc_id) - 1 AS rb,
  CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS BIGINT) AS m FROM split WHERE NOT is_test),
runs AS (SELECT 'a' AS model, doc_id, overall, text FROM tr WHERE ra < m
  UNION ALL SELECT 'b', doc_id, overall, text FROM tr WHERE rb < m),
prior AS (SELECT model, overall AS cls, count(*) / sum(count(*)) OVER (PARTITION BY model) AS p FROM runs GROUP BY model, overall),
tok AS (SELECT model, overall AS cls, unnest({WORDS.format(col='text')}) AS token FROM runs),
freq AS (SELECT model, cls, token, count(*) / sum(count(*)) OVER (PARTITION BY model, cls) AS p FROM tok GROUP BY model, cls, token),
tests AS (SELECT doc_id, overall, unnest({WORDS.format(col='text')}) AS token FROM split WHERE is_test),
sums AS (SELECT t.doc_id, p.model, p.cls, sum(ln(coalesce(f.p, 1e-10))) AS s FROM tests t CROSS JOIN prior p
  LEFT JOIN freq f ON f.model = p.model AND f.cls = p.cls AND f.token = t.token GROUP BY ALL),
scores AS (SELECT d.doc_id, d.overall, p.model, p.cls, ln(p.p) + coalesce(s.s, 0) AS s FROM (SELECT * FROM split WHERE is_test) d
  CROSS JOIN prior p LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.model = p.model AND s.cls = p.cls),
ex AS (SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id, model)) AS e FROM scores),
present AS (SELECT doc_id, overall, model, CAST(cls AS INTEGER) - 1 AS class_id, e / sum(e) OVER (PARTITION BY doc_id, model) AS p FROM ex),
probs AS (SELECT g.doc_id, CAST(g.overall AS INTEGER) - 1 AS label, g.model, CAST(g.class_id AS INTEGER) AS class_id, coalesce(p.p, 0) AS p
  FROM (SELECT DISTINCT doc_id, overall, model, unnest(range(5)) AS class_id FROM present) g
  LEFT JOIN present p ON p.doc_id = g.doc_id AND p.model = g.model AND p.class_id = g.class_id),
best AS (SELECT doc_id, model, label, class_id AS pred FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id, model ORDER BY p DESC, class_id) AS r FROM probs) WHERE r = 1),
rating AS (SELECT doc_id, model, label, sum(p * (class_id + 1)) AS rating FROM probs GROUP BY ALL),
voted AS (SELECT doc_id, class_id, avg(p) AS p FROM probs GROUP BY ALL)"""

SQL = {
    # The balance of a settled classifier is the number of reviews of the class; see the query.
    "classifier_fit": f"""WITH {SPLIT}, known AS (SELECT CAST(overall AS INTEGER) - 1 AS label, text FROM split WHERE NOT is_test),
words AS (SELECT count(DISTINCT token) + 1 AS places FROM (SELECT unnest({WORDS.format(col='text')}) AS token FROM known))
SELECT CAST(c.class_id AS INTEGER) AS class_id, count(label) AS reviews, count(label) AS balance, any_value(places) AS places, true AS settled
      FROM (SELECT unnest(range(5)) AS class_id) c LEFT JOIN known ON label = c.class_id CROSS JOIN words GROUP BY c.class_id""",
    "rating_class": f"""WITH {REVIEWS} SELECT d.doc_id, CAST(r.overall AS INTEGER) - 1 AS class_id
      FROM documents d LEFT JOIN reviews r ON r.doc_id = d.doc_id""",
    "pair_text": f"WITH {ALL_REVIEWS} SELECT doc_id, CAST(length({TEXT}) AS INTEGER) AS n_chars, md5({TEXT}) AS text_md5 FROM reviews",
    "vocab_encode": f"""WITH {SPLIT}, {positions()}, {ENCODED} SELECT doc_id, count(*) AS n_tokens,
      count(*) FILTER (token_id = 1) AS n_unknown, CAST(sum(token_id * (pos + 1)) AS BIGINT) AS id_sum FROM enc GROUP BY doc_id""",
    "truncate_seq": f"""WITH {ALL_REVIEWS}, lists AS (SELECT doc_id, {TOKENS.format(col=TEXT)} AS t FROM reviews) SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,
      CAST(least(len(t), 256) AS INTEGER) AS n_kept, md5(array_to_string(t[1:256], ' ')) AS kept_md5 FROM lists""",
    "pad_batch": f"""WITH {SPLIT}, {positions('[1:256]')}, {ENCODED},
      rows AS (SELECT doc_id, count(*) AS len, sum(token_id) AS id_sum, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch
        FROM enc GROUP BY doc_id)
      SELECT doc_id, batch, CAST(max(len) OVER (PARTITION BY batch) AS INTEGER) AS padded_length,
        CAST(len AS INTEGER) AS mask_sum, CAST(id_sum AS BIGINT) AS id_sum FROM rows""",
    "softmax_probs": f"WITH {PROBS} SELECT doc_id, model, class_id, round(p, 6) AS p FROM probs",
    "expected_rating": f"WITH {PROBS} SELECT doc_id, model, round(rating, 6) AS rating FROM rating",
    "prob_store": f"WITH {PROBS} SELECT doc_id, model, class_id, round(p, 6) AS p FROM probs",
    "soft_vote": f"WITH {PROBS} SELECT doc_id, class_id, round(p, 6) AS p FROM voted",
    "submission_csv": f"""WITH {PROBS} SELECT row_number() OVER (ORDER BY doc_id) AS "Id", round(sum(p * (class_id + 1)), 6) AS "Predicted"
      FROM voted GROUP BY doc_id""",
    "decision_rules": f"""WITH {PROBS} SELECT model, 'argmax' AS rule, round(sqrt(avg((label - pred) * (label - pred))), 6) AS rmse
      FROM best GROUP BY model
      UNION ALL SELECT model, 'expected', round(sqrt(avg((label + 1 - rating) * (label + 1 - rating))), 6) FROM rating GROUP BY model""",
    "log_loss": f"""WITH {PROBS} SELECT model, round(avg(-ln(greatest(p, 1e-15))), 6) AS loss FROM probs
      WHERE class_id = label GROUP BY model""",
    "batch_accuracy": f"""WITH {PROBS}, rows AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch FROM best WHERE model = 'a'),
      b AS (SELECT batch, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS m FROM rows GROUP BY batch)
      SELECT count(*) AS batches, round(avg(m), 6) AS accuracy FROM b""",
}
