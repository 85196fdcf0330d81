"""DuckDB SQL fragments for the oracle: the same definitions as the Spark
expressions, written independently so the two engines check each other."""

from __future__ import annotations

SENT = "chr(57344)"


def bucket(c: str) -> str:
    return f"(('0x'||substr(md5({c}),1,8))::BIGINT % 100)"


def split3(c: str) -> str:
    b = bucket(c)
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {b} < 80 THEN 'train' "
            f"WHEN {b} < 90 THEN 'validation' ELSE 'test' END")


def split2(c: str) -> str:
    b = bucket(c)
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {b} < 80 THEN 'train' ELSE 'test' END"


def toks(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '\\p{{L}}+'), lambda w: lower(w))"


def dtoks(c: str) -> str:
    return f"list_distinct({toks(c)})"


def rewrite(c: str, lex: str) -> str:
    """Segment rewrite with a list column ``lex`` of loaded terms."""
    segs = f"regexp_extract_all({c}, '\\p{{L}}+|[^\\p{{L}}]+')"
    marked = (f"array_to_string(list_transform({segs}, lambda s: CASE WHEN list_contains({lex}, lower(s)) "
              f"THEN {SENT} ELSE s END), '')")
    return (f"CASE WHEN {c} IS NULL OR strpos({c}, {SENT}) > 0 THEN NULL "
            f"ELSE regexp_replace({marked}, {SENT}||'[ \\t]?', '', 'g') END")


# Labelled documents (the proxy binding) with the two-way task split.
LABELLED = f"""
lab AS (
  SELECT d.doc_id, d.text, d.lang, l.quality, l.toxic, {split2('d.text')} AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

# Loaded terms learned on the train split of the sentiment proxy (toxic).
LOADED = f"""
{LABELLED.strip()},
lab_tok AS (
  SELECT doc_id, toxic, unnest({dtoks('text')}) AS term FROM lab WHERE split = 'train' AND text IS NOT NULL
),
loaded AS (
  SELECT term, count(*) AS df, count(*) FILTER (WHERE toxic = 1) AS pos,
         round(count(*) FILTER (WHERE toxic = 1) / count(*), 4) AS share
  FROM lab_tok GROUP BY term
  HAVING count(*) >= 8 AND count(*) FILTER (WHERE toxic = 1) * 10000 >= 9500 * count(*)
),
lex AS (SELECT coalesce(list(term), []::VARCHAR[]) AS lex FROM loaded)"""

# Every document rewritten with the learned lexicon.
REWRITTEN = f"""
{LOADED.strip()},
rw AS (
  SELECT d.doc_id, d.text, d.lang, {rewrite('d.text', 'lex.lex')} AS neutral
  FROM documents d, lex
)"""


def docs_cte(name: str = "sd") -> str:
    """Scored documents with a blank flag, and their distinct tokens."""
    return f"""
{name} AS (
  SELECT doc_id, text, lang, {split2('text')} AS split,
         (text IS NULL OR trim(text) = '') AS blank
  FROM documents
),
{name}_tok AS (SELECT doc_id, unnest({dtoks('text')}) AS term FROM {name} WHERE NOT blank)"""


def nb_train(t: str, src: str, label: str, min_df: int = 5) -> str:
    """Naive Bayes (binary presence, add-one) on ``src`` rows with split
    'train': priors ``{t}_prior(y, lp)`` and weights ``{t}_w(term, y, w)``."""
    return f"""
{t}_tr AS (
  SELECT CAST({label} AS VARCHAR) AS y, text FROM {src}
  WHERE split = 'train' AND text IS NOT NULL AND trim(text) <> '' AND {label} IS NOT NULL
),
{t}_prior AS (SELECT y, ln(count(*) / (SELECT count(*) FROM {t}_tr)) AS lp FROM {t}_tr GROUP BY y),
{t}_tok AS (SELECT y, unnest({dtoks('text')}) AS term FROM {t}_tr),
{t}_kept AS (SELECT term FROM {t}_tok GROUP BY term HAVING count(*) >= {min_df}),
{t}_cnt AS (
  SELECT k.term, p.y, count(tk.term) AS n
  FROM {t}_kept k CROSS JOIN {t}_prior p LEFT JOIN {t}_tok tk ON tk.term = k.term AND tk.y = p.y
  GROUP BY k.term, p.y
),
{t}_tot AS (SELECT y, sum(n) AS tc FROM {t}_cnt GROUP BY y),
{t}_w AS (
  SELECT c.term, c.y, ln(CAST(c.n + 1 AS DOUBLE) / CAST(s.tc + (SELECT count(*) FROM {t}_kept) AS DOUBLE)) AS w
  FROM {t}_cnt c JOIN {t}_tot s ON s.y = c.y
)"""


def nb_apply(t: str, scored: str, p: str) -> str:
    """Scores of model ``t`` on ``scored`` (doc_id, blank) with tokens in
    ``{scored}_tok``; ends in ``{p}_res(doc_id, {p}_label, {p}_conf, {p}_s,
    {p}_p1)``: ``_s`` = logp('1') - logp('0'), ``_p1`` = P('1')."""
    return f"""
{p}_sum AS (
  SELECT dt.doc_id, w.y, sum(w.w) AS sw FROM {scored}_tok dt JOIN {t}_w w ON dt.term = w.term
  GROUP BY dt.doc_id, w.y
),
{p}_lp AS (
  SELECT d.doc_id, pr.y, pr.lp + coalesce(s.sw, 0) AS lp
  FROM {scored} d CROSS JOIN {t}_prior pr LEFT JOIN {p}_sum s ON s.doc_id = d.doc_id AND s.y = pr.y
  WHERE NOT d.blank
),
{p}_rk AS (
  SELECT doc_id, y, lp, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, y ASC) AS rk,
         max(lp) OVER (PARTITION BY doc_id) AS mx
  FROM {p}_lp
),
{p}_py AS (SELECT doc_id, y, exp(lp - mx) / sum(exp(lp - mx)) OVER (PARTITION BY doc_id) AS p FROM {p}_rk),
{p}_res AS (
  SELECT doc_id, max(y) FILTER (WHERE rk = 1) AS {p}_label, 1.0 / sum(exp(lp - mx)) AS {p}_conf,
         max(lp) FILTER (WHERE y = '1') - max(lp) FILTER (WHERE y = '0') AS {p}_s,
         max(exp(lp - mx)) FILTER (WHERE y = '1') / sum(exp(lp - mx)) AS {p}_p1
  FROM {p}_rk GROUP BY doc_id
)"""


def nb(t: str, src: str, label: str, scored: str = "sd", min_df: int = 5) -> str:
    return nb_train(t, src, label, min_df).strip() + ",\n" + nb_apply(t, scored, t).strip()


def nb_all(scored: str = "sd") -> str:
    """Docs, labelled corpus and the three task models."""
    return ",\n".join([docs_cte(scored).strip(), LABELLED.strip(),
                       nb("truth", "lab", "quality", scored).strip(),
                       nb("sentiment", "lab", "toxic", scored).strip(),
                       nb("bias", scored, "lang", scored).strip()])


TASK_SOURCES = (("truth", "lab", "quality"), ("sentiment", "lab", "toxic"), ("bias", "sd", "lang"))


def rescored() -> str:
    """Docs, lexicon, rewrite, the three models, and their scores on both the
    original (``{task}_res``) and the rewrite (``after_{task}_res``)."""
    parts = [docs_cte("sd").strip(), LOADED.strip(),
             f"""rw AS (
  SELECT d.doc_id, d.text, d.lang, d.split, {rewrite('d.text', 'lex.lex')} AS neutral FROM sd d, lex
),
sa AS (SELECT doc_id, neutral AS text, (neutral IS NULL OR trim(neutral) = '') AS blank FROM rw),
sa_tok AS (SELECT doc_id, unnest({dtoks('text')}) AS term FROM sa WHERE NOT blank)"""]
    for t, src, label in TASK_SOURCES:
        parts.append(nb_train(t, src, label).strip())
        parts.append(nb_apply(t, "sd", t).strip())
        parts.append(nb_apply(t, "sa", f"after_{t}").strip())
    return ",\n".join(parts)


def clean(x: str) -> str:
    """Tag removal, entity decoding and whitespace collapse of an HTML fragment."""
    y = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        y = f"replace({y}, '{ent}', '{ch}')"
    return f"nullif(trim(regexp_replace({y}, '[ \\t\\r\\n]+', ' ', 'g')), '')"


def uniform(c: str) -> str:
    return f"(CAST(('0x'||substr(md5({c}),1,8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE)"


def test_rows() -> str:
    """Held-out rows per task: ``ev_rows(task, doc_id, label)``."""
    return """ev_rows AS (
  SELECT 'truth' AS task, doc_id, CAST(quality AS VARCHAR) AS label FROM lab WHERE split = 'test'
  UNION ALL SELECT 'sentiment', doc_id, CAST(toxic AS VARCHAR) FROM lab WHERE split = 'test'
  UNION ALL SELECT 'bias', doc_id, lang FROM sd WHERE split = 'test'
)"""


def hashed_all(bits: int = 17, min_df: int = 5) -> str:
    """The hashed scorer over the documents ``sd``: slots, weights in millionths, and per task
    ``h_{task}_res(doc_id, {task}_label, {task}_conf)``; a term is its md5's first 36 bits."""
    parts = [docs_cte("sd").strip(), f"""
h_tok AS (SELECT doc_id, unnest(list_distinct(list_transform({toks('text')}, lambda w: ('0x'||substr(md5(w),1,9))::BIGINT))) AS key
          FROM sd WHERE NOT blank),
h_train AS (SELECT sd.doc_id, CAST(l.quality AS VARCHAR) AS truth_y, CAST(l.toxic AS VARCHAR) AS sentiment_y, sd.lang AS bias_y
            FROM sd LEFT JOIN labels l ON l.doc_id = sd.doc_id WHERE sd.split = 'train' AND NOT sd.blank),
h_kt AS (SELECT t.*, k.key FROM h_train t JOIN h_tok k ON k.doc_id = t.doc_id),
h_df AS (SELECT key, count(*) AS df FROM h_kt GROUP BY key HAVING count(*) >= {min_df}),
h_slot AS (SELECT key FROM (SELECT key, row_number() OVER (PARTITION BY key >> {36 - bits} ORDER BY df DESC, key ASC) AS r FROM h_df) WHERE r = 1)""".strip()]
    for t, _, _ in TASK_SOURCES:
        h = f"h_{t}"
        parts.append(f"""
{h}_n AS (SELECT k.key, k.{t}_y AS y, count(*) AS n FROM h_kt k JOIN h_slot s ON s.key = k.key WHERE k.{t}_y IS NOT NULL GROUP BY k.key, k.{t}_y),
{h}_kept AS (SELECT key FROM {h}_n GROUP BY key HAVING sum(n) >= {min_df}),
{h}_cl AS (SELECT {t}_y AS y, count(*) AS c FROM h_train WHERE {t}_y IS NOT NULL GROUP BY {t}_y),
{h}_cnt AS (SELECT k.key, c.y, coalesce(n.n, 0) AS n FROM {h}_kept k CROSS JOIN {h}_cl c LEFT JOIN {h}_n n ON n.key = k.key AND n.y = c.y),
{h}_tot AS (SELECT y, sum(n) + (SELECT count(*) FROM {h}_kept) AS tc FROM {h}_cnt GROUP BY y),
{h}_lw AS (SELECT c.key, c.y, ln(CAST(c.n + 1 AS DOUBLE) / CAST(s.tc AS DOUBLE)) AS lw FROM {h}_cnt c JOIN {h}_tot s ON s.y = c.y),
{h}_w AS (SELECT a.key, a.y, CAST(round(1e6 * (a.lw - b.lw)) AS BIGINT) AS w FROM {h}_lw a JOIN {h}_lw b ON b.key = a.key AND b.y = (SELECT min(y) FROM {h}_cl)),
{h}_prior AS (SELECT y, CAST(round(1e6 * ln(c / (SELECT c FROM {h}_cl ORDER BY y LIMIT 1))) AS BIGINT) AS w FROM {h}_cl),
{h}_sum AS (SELECT k.doc_id, w.y, sum(w.w) AS s FROM h_tok k JOIN {h}_w w ON w.key = k.key GROUP BY k.doc_id, w.y),
{h}_lp AS (SELECT sd.doc_id, p.y, p.w + coalesce(s.s, 0) AS lp FROM sd CROSS JOIN {h}_prior p LEFT JOIN {h}_sum s ON s.doc_id = sd.doc_id AND s.y = p.y WHERE NOT sd.blank),
{h}_rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, y ASC) AS rk, max(lp) OVER (PARTITION BY doc_id) AS mx FROM {h}_lp),
{h}_res AS (SELECT doc_id, max(y) FILTER (WHERE rk = 1) AS {t}_label, 1.0 / sum(exp(CAST(lp - mx AS DOUBLE) / 1e6)) AS {t}_conf FROM {h}_rk GROUP BY doc_id)""".strip())
    return ",\n".join(parts)


def folds(min_dfs=(5, 3), k: int = 5) -> str:
    """Cross-validation on the train rows: ``cv(task, model, doc_id, label, pred)`` and the candidates'
    parameters ``cv_params(task, model, n_params)``. A fold's counts are those of all rows less its own."""
    parts = [docs_cte("sd").strip(), LABELLED.strip()]
    preds, params = [], []
    for t, src, label in TASK_SOURCES:
        h = f"cv_{t}"
        parts.append(f"""
{h}_tr AS (SELECT doc_id, CAST({label} AS VARCHAR) AS y, text, {bucket('text')} % {k} AS f FROM {src}
           WHERE split = 'train' AND text IS NOT NULL AND trim(text) <> '' AND {label} IS NOT NULL),
{h}_tok AS (SELECT doc_id, y, f, unnest({dtoks('text')}) AS term FROM {h}_tr),
{h}_cl AS (SELECT DISTINCT y FROM {h}_tr),
{h}_f AS (SELECT unnest(range({k + 1})) AS f),
{h}_all AS (SELECT term, y, count(*) AS n FROM {h}_tok GROUP BY term, y),
{h}_own AS (SELECT term, y, f, count(*) AS n FROM {h}_tok GROUP BY term, y, f),
{h}_n AS (SELECT x.f, v.term, c.y, coalesce(a.n, 0) - coalesce(o.n, 0) AS n
          FROM (SELECT DISTINCT term FROM {h}_all) v CROSS JOIN {h}_cl c CROSS JOIN {h}_f x
          LEFT JOIN {h}_all a ON a.term = v.term AND a.y = c.y LEFT JOIN {h}_own o ON o.term = v.term AND o.y = c.y AND o.f = x.f),
{h}_prior AS (SELECT x.f, c.y, count(r.doc_id) AS n FROM {h}_f x CROSS JOIN {h}_cl c LEFT JOIN {h}_tr r ON r.y = c.y AND r.f <> x.f GROUP BY x.f, c.y),
{h}_p AS (SELECT f, y, n, sum(n) OVER (PARTITION BY f) AS total, row_number() OVER (PARTITION BY f ORDER BY n DESC, y) AS rk FROM {h}_prior)""".strip())
        preds.append(f"SELECT '{t}' AS task, 'majority' AS model, r.doc_id, r.y AS label, p.y AS pred FROM {h}_tr r JOIN {h}_p p ON p.f = r.f AND p.rk = 1")
        params.append(f"SELECT '{t}' AS task, 'majority' AS model, 1 AS n_params")
        for m in min_dfs:
            g = f"{h}_{m}"
            parts.append(f"""
{g}_kept AS (SELECT f, term FROM {h}_n GROUP BY f, term HAVING sum(n) >= {m}),
{g}_v AS (SELECT f, count(*) AS v FROM {g}_kept GROUP BY f),
{g}_t AS (SELECT n.f, n.y, sum(n.n) AS t FROM {h}_n n JOIN {g}_kept k ON k.f = n.f AND k.term = n.term GROUP BY n.f, n.y),
{g}_w AS (SELECT n.f, n.term, n.y, ln((n.n + 1)::DOUBLE / (t.t + v.v)::DOUBLE) AS w
          FROM {h}_n n JOIN {g}_kept k ON k.f = n.f AND k.term = n.term JOIN {g}_t t ON t.f = n.f AND t.y = n.y JOIN {g}_v v ON v.f = n.f),
{g}_s AS (SELECT o.doc_id, w.y, sum(w.w) AS s FROM {h}_tok o JOIN {g}_w w ON w.f = o.f AND w.term = o.term GROUP BY o.doc_id, w.y),
{g}_rk AS (SELECT r.doc_id, r.y AS label, p.y AS pred, row_number() OVER (PARTITION BY r.doc_id ORDER BY CASE WHEN p.n > 0 THEN ln(p.n / p.total) ELSE -1e300 END + coalesce(s.s, 0) DESC, p.y) AS rk
           FROM {h}_tr r JOIN {h}_p p ON p.f = r.f LEFT JOIN {g}_s s ON s.doc_id = r.doc_id AND s.y = p.y)""".strip())
            preds.append(f"SELECT '{t}', 'nb_df{m}', doc_id, label, pred FROM {g}_rk WHERE rk = 1")
            params.append(f"SELECT '{t}', 'nb_df{m}', (coalesce((SELECT v FROM {g}_v WHERE f = {k}), 0) + 1) * (SELECT count(*) FROM {h}_cl)")
    parts.append("cv AS (" + " UNION ALL ".join(preds) + ")")
    parts.append("cv_params AS (" + " UNION ALL ".join(params) + ")")
    parts.append("""cv_rec AS (SELECT c.task, c.model, count(*) AS n, count(*) FILTER (WHERE label = pred) AS correct,
       round(count(*) FILTER (WHERE label = pred) / count(*), 4) AS accuracy, any_value(p.n_params)::BIGINT AS n_params
FROM cv c JOIN cv_params p ON p.task = c.task AND p.model = c.model GROUP BY c.task, c.model),
cv_pair AS (SELECT a.task, a.model AS model_a, b.model AS model_b, count(*) FILTER (WHERE a.label = a.pred AND b.label <> b.pred) AS a_only,
       count(*) FILTER (WHERE b.label = b.pred AND a.label <> a.pred) AS b_only
FROM cv a JOIN cv b ON b.task = a.task AND b.doc_id = a.doc_id AND b.model > a.model GROUP BY a.task, a.model, b.model),
cv_test AS (SELECT *, CASE WHEN a_only + b_only > 0 THEN power(greatest(abs(a_only - b_only) - 1, 0), 2)::DOUBLE / (a_only + b_only) ELSE 0.0 END AS stat FROM cv_pair),
cv_best AS (SELECT task, model FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY correct DESC, n_params, model) AS r FROM cv_rec) WHERE r = 1),
cv_choice AS (SELECT task, model, accuracy, n_params FROM (SELECT r.*, row_number() OVER (PARTITION BY r.task ORDER BY n_params, r.model) AS k
  FROM cv_rec r JOIN cv_best b ON b.task = r.task WHERE NOT EXISTS (SELECT 1 FROM cv_test x WHERE x.task = r.task AND x.stat > 3.841459
    AND ((x.model_a = r.model AND x.model_b = b.model) OR (x.model_b = r.model AND x.model_a = b.model)))) WHERE k = 1)""")
    return ",\n".join(parts)
