"""Registered queries: one per operator of the inventory. Each takes
``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE`` holds the DuckDB SQL of
the same result where one exists (same column names)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.operators import compare as cmp
from evenline.operators import metrics
from evenline.operators import rewrite as rw
from evenline.operators import scoring as sc
from evenline.operators.splits import holdout_split
from evenline.plans import sql as S
from evenline.plans.context import DISPLAY, THREE_WAY, Context
from evenline.sources.corpus import documents

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def ctx(spark: SparkSession, sf_dir: str) -> Context:
    return Context.get(spark, sf_dir)


# --- M1: sources, splits, lexicon, rewrite ----------------------------------

@query("english_only", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def q_english_only(spark, sf_dir):
    from evenline.operators.filters import english_only
    return english_only(documents(spark, sf_dir)).select("doc_id", "text")


@query("holdout_split", f"SELECT doc_id, {S.split3('text')} AS split FROM documents")
def q_holdout_split(spark, sf_dir):
    return holdout_split(documents(spark, sf_dir), "text", THREE_WAY).select("doc_id", "split")


@query("loaded_terms", f"WITH {S.LOADED.strip()} SELECT term, df, pos, share FROM loaded")
def q_loaded_terms(spark, sf_dir):
    return ctx(spark, sf_dir).loaded_terms.select("term", "df", "pos", "share")


def rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ctx(spark, sf_dir)
    lex = c.lexicon_terms if c.lexicon_terms is not None else c.loaded_terms
    return rw.neutral_rewrite(c.docs, lex, "text", "neutral", key="doc_id")


@query("neutral_rewrite", f"""WITH {S.REWRITTEN.strip()}
SELECT doc_id, neutral, neutral IS DISTINCT FROM text AS changed FROM rw""")
def q_neutral_rewrite(spark, sf_dir):
    return rewritten(spark, sf_dir).select(
        "doc_id", "neutral", (~F.col("neutral").eqNullSafe(F.col("text"))).alias("changed"))


@query("removed_terms", f"""WITH {S.REWRITTEN.strip()},
ch AS (SELECT doc_id, text, neutral FROM rw WHERE neutral IS DISTINCT FROM text AND text IS NOT NULL),
b AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest({S.toks('text')}) AS term FROM ch) GROUP BY doc_id, term),
a AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest({S.toks('neutral')}) AS term FROM ch) GROUP BY doc_id, term),
r AS (SELECT b.doc_id, b.term, b.c - coalesce(a.c, 0) AS removed FROM b LEFT JOIN a ON a.doc_id = b.doc_id AND a.term = b.term)
SELECT term, count(doc_id) AS n_docs, sum(removed)::BIGINT AS n_removed FROM r WHERE removed > 0 GROUP BY term""")
def q_removed_terms(spark, sf_dir):
    per_row = rw.removed_terms(rewritten(spark, sf_dir), "doc_id", "text", "neutral")
    return rw.removed_summary(per_row, "doc_id")


# --- M2: models, scoring, evaluation -----------------------------------------

TASKS = ("truth", "sentiment", "bias")


def analysed(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """All three task results per document, in one scoring pass."""
    c = ctx(spark, sf_dir)
    return sc.analyse(c.docs if docs is None else docs, c.model_set, "doc_id", "text")


def _round(t: str, x: str) -> str:
    return f"round({t}_res.{t}_{x}, 4) AS {t}_{x}"


_ALL_RES = " ".join(f"LEFT JOIN {t}_res ON {t}_res.doc_id = sd.doc_id" for t in TASKS)


@query("score_truth", f"""WITH {S.nb_all()}
SELECT sd.doc_id, {_round('truth', 's')}, truth_res.truth_label AS truth_label, {_round('truth', 'conf')}
FROM sd {_ALL_RES}""")
def q_score_truth(spark, sf_dir):
    c = ctx(spark, sf_dir)
    s = sc.score(c.docs, c.models["truth"], "doc_id", "text")
    return s.select("doc_id", F.round("truth_s", 4).alias("truth_s"), "truth_label",
                    F.round("truth_conf", 4).alias("truth_conf"))


@query("score_sentiment", f"""WITH {S.nb_all()}
SELECT sd.doc_id, {_round('sentiment', 's')}, sentiment_res.sentiment_label AS sentiment_label,
       {_round('sentiment', 'conf')}
FROM sd {_ALL_RES}""")
def q_score_sentiment(spark, sf_dir):
    c = ctx(spark, sf_dir)
    s = sc.score(c.docs, c.models["sentiment"], "doc_id", "text")
    return s.select("doc_id", F.round("sentiment_s", 4).alias("sentiment_s"), "sentiment_label",
                    F.round("sentiment_conf", 4).alias("sentiment_conf"))


@query("score_bias", f"""WITH {S.nb_all()}
SELECT sd.doc_id, bias_res.bias_label AS bias_label, {_round('bias', 'conf')}
FROM sd {_ALL_RES}""")
def q_score_bias(spark, sf_dir):
    c = ctx(spark, sf_dir)
    s = sc.score(c.docs, c.models["bias"], "doc_id", "text")
    return s.select("doc_id", "bias_label", F.round("bias_conf", 4).alias("bias_conf"))


@query("analyse", f"""WITH {S.nb_all()}
SELECT sd.doc_id, {', '.join(f"{t}_res.{t}_label AS {t}_label, {_round(t, 'conf')}" for t in TASKS)}
FROM sd {_ALL_RES}""")
def q_analyse(spark, sf_dir):
    a = analysed(spark, sf_dir)
    return sc.label_confidence(a, "doc_id", TASKS).select(
        "doc_id", *[x for t in TASKS for x in (F.col(f"{t}_label"), F.round(f"{t}_conf", 4).alias(f"{t}_conf"))])


def evaluation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(task, label, pred)`` on the held-out split: proxy labels vs predictions."""
    c = ctx(spark, sf_dir)
    test = c.docs.where(F.col("split") == "test")
    a = sc.analyse(test, c.model_set, "doc_id", "text", carry=["lang"])
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    j = a.join(labels, "doc_id", "left")
    pairs = F.array(*[F.struct(F.lit(t).alias("task"), F.col(lab).cast("string").alias("label"),
                               F.col(f"{t}_label").alias("pred"))
                      for t, lab in (("truth", "quality"), ("sentiment", "toxic"), ("bias", "lang"))])
    return j.select(F.explode(pairs).alias("e")).select("e.task", "e.label", "e.pred")


_EVAL_SQL = f"""WITH {S.nb_all()},
ev AS (
  SELECT 'truth' AS task, CAST(l.quality AS VARCHAR) AS label, truth_res.truth_label AS pred
  FROM sd LEFT JOIN labels l ON l.doc_id = sd.doc_id LEFT JOIN truth_res ON truth_res.doc_id = sd.doc_id
  WHERE sd.split = 'test'
  UNION ALL
  SELECT 'sentiment', CAST(l.toxic AS VARCHAR), sentiment_res.sentiment_label
  FROM sd LEFT JOIN labels l ON l.doc_id = sd.doc_id LEFT JOIN sentiment_res ON sentiment_res.doc_id = sd.doc_id
  WHERE sd.split = 'test'
  UNION ALL
  SELECT 'bias', sd.lang, bias_res.bias_label
  FROM sd LEFT JOIN bias_res ON bias_res.doc_id = sd.doc_id
  WHERE sd.split = 'test'
)"""


@query("accuracy", f"""{_EVAL_SQL}
SELECT task, count(*) AS n, count(*) FILTER (WHERE label = pred) AS correct,
       round(count(*) FILTER (WHERE label = pred) / count(*), 4) AS accuracy
FROM ev WHERE label IS NOT NULL AND pred IS NOT NULL GROUP BY task""")
def q_accuracy(spark, sf_dir):
    return metrics.accuracy(evaluation_rows(spark, sf_dir), "label", "pred", by=["task"])


@query("confusion", f"""{_EVAL_SQL}
SELECT task, label, pred, count(*) AS n FROM ev
WHERE label IS NOT NULL AND pred IS NOT NULL GROUP BY task, label, pred""")
def q_confusion(spark, sf_dir):
    return metrics.confusion(evaluation_rows(spark, sf_dir), "label", "pred", by=["task"])


NEAR = {"bias": sc.TAU_NEAR}


def _fmt_sql(t: str, display: dict[str, str] | None) -> str:
    lab = f"{t}_res.{t}_label"
    if display:
        lab = "CASE " + " ".join(f"WHEN {lab} = '{k}' THEN '{v}'" for k, v in display.items()) + " END"
    if t in NEAR:
        lab = f"CASE WHEN {t}_res.{t}_conf < {NEAR[t]} THEN '{sc.NEAR_NEUTRAL}' ELSE {lab} END"
    return (f"CASE WHEN {t}_res.{t}_label IS NULL OR {t}_res.{t}_conf IS NULL THEN NULL "
            f"ELSE printf('%s (%.1f%%)', {lab}, round({t}_res.{t}_conf * 100.0, 1)) END AS {t}_fmt")


@query("format_confidence", f"""WITH {S.nb_all()}
SELECT sd.doc_id, {', '.join(_fmt_sql(t, DISPLAY.get(t)) for t in TASKS)}
FROM sd {_ALL_RES}""")
def q_format_confidence(spark, sf_dir):
    a = analysed(spark, sf_dir)
    return sc.format_confidence(a, TASKS, DISPLAY, NEAR).select("doc_id", *[f"{t}_fmt" for t in TASKS])


# --- M3: prompt, rescore, compare, chart rows, summary ---------------------------

def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrite every document, rescore both texts in one pass, compare."""
    c = ctx(spark, sf_dir)
    r = rewritten(spark, sf_dir).withColumn("changed", ~F.col("neutral").eqNullSafe(F.col("text")))
    s = cmp.rescore(r, c.model_set, "doc_id", "text", "neutral",
                    carry=["lang", "split", "changed"])
    return cmp.compare_before_after(s, c.models, "doc_id", TASKS, carry=["lang", "split", "changed"])


@query("build_prompt", f"""WITH {S.nb_all()}
SELECT doc_id, CASE WHEN truth_fmt IS NULL OR sentiment_fmt IS NULL OR bias_fmt IS NULL OR text IS NULL THEN NULL
       ELSE printf('{rw.PROMPT_TEMPLATE}', truth_fmt, sentiment_fmt, bias_fmt, text) END AS prompt
FROM (SELECT sd.doc_id, sd.text, {', '.join(_fmt_sql(t, DISPLAY.get(t)) for t in TASKS)} FROM sd {_ALL_RES})""")
def q_build_prompt(spark, sf_dir):
    from evenline.operators.inline import score_rows
    c = ctx(spark, sf_dir)
    scored = score_rows(c.docs.select("doc_id", "text"), {"": "text"}, c.model_set)
    return rw.build_prompt(sc.format_confidence(scored, TASKS, DISPLAY, NEAR), "text").select("doc_id", "prompt")


_AXIS_SQL = {"truth_probability": "truth_res.truth_p1", "emotional_intensity": "sentiment_res.sentiment_p1",
             "bias_degree": "bias_res.bias_conf"}
_RESCORED_JOIN = " ".join(f"LEFT JOIN {p}{t}_res ON {p}{t}_res.doc_id = rw.doc_id"
                          for t in TASKS for p in ("", "after_"))
_COMPARED_SQL = f"""WITH {S.rescored()},
cmp AS (
  SELECT rw.doc_id, rw.lang, rw.split, rw.neutral IS DISTINCT FROM rw.text AS changed,
  {', '.join(f'''{t}_res.{t}_label AS {t}_before, after_{t}_res.after_{t}_label AS {t}_after,
  CASE WHEN {t}_res.{t}_label IS NOT NULL AND after_{t}_res.after_{t}_label IS NOT NULL
       THEN {t}_res.{t}_label <> after_{t}_res.after_{t}_label END AS {t}_flip''' for t in TASKS)},
  {', '.join(f"{v} AS before_{ax}, {v.replace(v.split('.')[0], 'after_' + v.split('.')[0]).replace('.', '.after_', 1)} AS after_{ax}" for ax, v in _AXIS_SQL.items())}
  FROM rw {_RESCORED_JOIN}
)"""


@query("before_after", f"""{_COMPARED_SQL}
SELECT doc_id, {', '.join(f'{t}_before, {t}_after, {t}_flip' for t in TASKS)},
       {', '.join(f'(round(after_{ax} - before_{ax}, 4) + 0.0) AS {ax}_delta' for ax in cmp.AXES)}
FROM cmp""")
def q_before_after(spark, sf_dir):
    d = compared(spark, sf_dir)
    return d.select("doc_id", *[f"{t}_{x}" for t in TASKS for x in ("before", "after", "flip")],
                    *[F.round(f"{ax}_delta", 4).alias(f"{ax}_delta") for ax in cmp.AXES])


@query("radar_rows", f"""{_COMPARED_SQL}
{' UNION ALL '.join(f"SELECT doc_id, '{p}' AS phase, '{ax}' AS axis, round({p}_{ax}, 4) AS value FROM cmp"
                    for p in cmp.PHASES for ax in cmp.AXES)}""")
def q_radar_rows(spark, sf_dir):
    return cmp.radar_rows(compared(spark, sf_dir), "doc_id")


@query("effect_summary", f"""{_COMPARED_SQL}
SELECT split, lang, count(*) AS n, count(*) FILTER (WHERE changed) AS n_changed,
       round(avg(CAST(changed AS DOUBLE)), 4) AS share_changed,
       {', '.join(f'(round(avg(after_{ax} - before_{ax}), 4) + 0.0) AS {ax}_delta_mean' for ax in cmp.AXES)},
       {', '.join(f'round(avg(CAST({t}_flip AS DOUBLE)), 4) AS {t}_flip_rate' for t in TASKS)}
FROM cmp GROUP BY ROLLUP (split, lang)""")
def q_effect_summary(spark, sf_dir):
    return cmp.effect_summary(compared(spark, sf_dir), "changed", ["split", "lang"], TASKS)


def _gram_sql(col: str, n: int) -> str:
    t = S.toks(col)
    if n == 1:
        return t
    parts = " || ' ' || ".join(f"tt[i + {k}]" for k in range(n))
    return f"(SELECT list_transform(range(1, len(tt) - {n - 2}), lambda i: {parts}) FROM (SELECT {t} AS tt))"


def _rouge_sql(n: int) -> str:
    return f"""WITH {S.REWRITTEN.strip()},
g AS (SELECT doc_id, {_gram_sql('text', n)} AS rg, {_gram_sql('neutral', n)} AS hg FROM rw),
rc AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(rg) AS x FROM g) GROUP BY doc_id, x),
hc AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(hg) AS x FROM g) GROUP BY doc_id, x),
ov AS (SELECT rc.doc_id, sum(least(rc.c, hc.c)) AS o FROM rc JOIN hc ON rc.doc_id = hc.doc_id AND rc.x = hc.x GROUP BY rc.doc_id),
m AS (SELECT g.doc_id, len(rg) AS nr, len(hg) AS nh,
             CASE WHEN rg IS NULL OR hg IS NULL THEN NULL ELSE CAST(coalesce(ov.o, 0) AS BIGINT) END AS o
      FROM g LEFT JOIN ov ON ov.doc_id = g.doc_id)
SELECT doc_id, o AS rouge{n}_overlap,
       round(CASE WHEN nh > 0 THEN o / nh END, 4) AS rouge{n}_p,
       round(CASE WHEN nr > 0 THEN o / nr END, 4) AS rouge{n}_r,
       round(CASE WHEN nr + nh > 0 THEN 2.0 * o / (nr + nh) END, 4) AS rouge{n}_f1
FROM m"""


@query("rouge1", _rouge_sql(1))
def q_rouge1(spark, sf_dir):
    return metrics.rouge_n(rewritten(spark, sf_dir), "doc_id", "text", "neutral", 1)


@query("rouge2", _rouge_sql(2))
def q_rouge2(spark, sf_dir):
    return metrics.rouge_n(rewritten(spark, sf_dir), "doc_id", "text", "neutral", 2)


@query("meaning_preserved", f"""WITH {S.REWRITTEN.strip()},
g AS (SELECT doc_id, {S.toks('text')} AS rg, {S.toks('neutral')} AS hg FROM rw),
rc AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(rg) AS x FROM g) GROUP BY doc_id, x),
hc AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(hg) AS x FROM g) GROUP BY doc_id, x),
ov AS (SELECT rc.doc_id, sum(least(rc.c, hc.c)) AS o FROM rc JOIN hc ON rc.doc_id = hc.doc_id AND rc.x = hc.x GROUP BY rc.doc_id),
m AS (SELECT g.doc_id, len(rg) AS nr, len(hg) AS nh, coalesce(ov.o, 0) AS o,
             len(list_intersect(rg, hg)) AS ni, len(list_distinct(list_concat(rg, hg))) AS nu
      FROM g LEFT JOIN ov ON ov.doc_id = g.doc_id)
SELECT doc_id, round(CASE WHEN nr + nh > 0 THEN 2.0 * o / (nr + nh) END, 4) AS rouge1_f1,
       round(CASE WHEN nu > 0 THEN ni / nu END, 4) AS jaccard,
       CASE WHEN nr + nh > 0 THEN round(2.0 * o / (nr + nh), 4) >= 0.8 END AS preserved
FROM m""")
def q_meaning_preserved(spark, sf_dir):
    return cmp.meaning_preserved(rewritten(spark, sf_dir), "doc_id", "text", "neutral", min_f1=0.8)


# --- M4: fields, profiles, subsets, losses, model choice ----------------------

@query("concat_fields", f"""SELECT page_id, title, heading, body,
       nullif(concat_ws(' ', nullif(trim(title), ''), nullif(trim(heading), ''), nullif(trim(body), '')), '') AS text
FROM (SELECT page_id,
             {S.clean("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
             {S.clean("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
             {S.clean("array_to_string(regexp_extract_all(html, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1), ' ')")} AS body
      FROM pages)""")
def q_concat_fields(spark, sf_dir):
    from evenline.sources.pages import page_text
    return page_text(ctx(spark, sf_dir).table("pages").select("page_id", "html")).select(
        "page_id", "title", "heading", "body", "text")


@query("split_profile", f"""WITH {S.docs_cte().strip()}, {S.LABELLED.strip()}
SELECT task, split, label, count(*) AS n FROM (
  SELECT 'truth' AS task, split, CAST(quality AS VARCHAR) AS label FROM lab
  UNION ALL SELECT 'sentiment', split, CAST(toxic AS VARCHAR) FROM lab
  UNION ALL SELECT 'bias', split, lang FROM sd
) GROUP BY task, split, label""")
def q_split_profile(spark, sf_dir):
    from evenline.operators.splits import split_profile
    c = ctx(spark, sf_dir)
    parts = [c.task(t).select(F.lit(t).alias("task"), "split", "label") for t in TASKS]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return split_profile(u, ("task", "split", "label"))


STAGE_SIZES = (1000, 5000, 10000)  # the reference's rewriter ladder


@query("staged_subsets", f"""WITH {S.docs_cte().strip()},
tr AS (SELECT doc_id, row_number() OVER (ORDER BY md5(text), doc_id) AS rk FROM sd WHERE split = 'train')
SELECT st.stage, tr.doc_id FROM tr JOIN (VALUES {', '.join(f'({s})' for s in STAGE_SIZES)}) st(stage)
ON tr.rk <= st.stage""")
def q_staged_subsets(spark, sf_dir):
    from evenline.operators.splits import staged_subsets
    train = ctx(spark, sf_dir).docs.where(F.col("split") == "train")
    return staged_subsets(train, STAGE_SIZES, "text", "doc_id").select("stage", "doc_id")


def _task_test(c: Context, t: str) -> DataFrame:
    return c.task(t).where(F.col("split") == "test")


@query("log_loss", f"""WITH {S.nb_all()}, {S.test_rows()},
py AS (
  SELECT 'truth' AS task, doc_id, y, p FROM truth_py
  UNION ALL SELECT 'sentiment', doc_id, y, p FROM sentiment_py
  UNION ALL SELECT 'bias', doc_id, y, p FROM bias_py
)
SELECT e.task, count(*) AS n, round(avg(-ln(greatest(coalesce(p.p, 0.0), 1e-15))), 4) AS log_loss
FROM ev_rows e JOIN (SELECT DISTINCT task, doc_id FROM py) s ON s.task = e.task AND s.doc_id = e.doc_id
LEFT JOIN py p ON p.task = e.task AND p.doc_id = e.doc_id AND p.y = e.label
WHERE e.label IS NOT NULL GROUP BY e.task""")
def q_log_loss(spark, sf_dir):
    c = ctx(spark, sf_dir)
    _, test = _all_tasks(c)
    s = sc.analyse(test, c.model_set, "doc_id", "text", carry=sorted(set(TASK_LABELS.values())))
    return metrics.evaluate_long(s, [(t, None, lab, t, c.models[t].classes) for t, lab in TASK_LABELS.items()]).select("task", "n", "log_loss")


@query("rouge_l", f"""WITH {S.REWRITTEN.strip()},
-- the lexicon rewriter deletes whole tokens, so the rewrite's tokens are a
-- subsequence of the original's and LCS = number of rewrite tokens
g AS (SELECT doc_id, len({S.toks('text')}) AS nr, len({S.toks('neutral')}) AS nh FROM rw)
SELECT doc_id, CAST(nh AS BIGINT) AS lcs,
       round(CASE WHEN nh > 0 THEN nh / nh END, 4) AS rougeL_p,
       round(CASE WHEN nr > 0 THEN nh / nr END, 4) AS rougeL_r,
       round(CASE WHEN nr + nh > 0 THEN 2.0 * nh / (nr + nh) END, 4) AS rougeL_f1
FROM g""")
def q_rouge_l(spark, sf_dir):
    return metrics.rouge_l(rewritten(spark, sf_dir), "doc_id", "text", "neutral")


CANDIDATE_MIN_DF = (5, 3)


def _nb_candidates_sql() -> str:
    parts = [S.docs_cte().strip(), S.LABELLED.strip(), S.test_rows()]
    recs = []
    for t, src, label in S.TASK_SOURCES:
        parts.append(f"""{t}_maj AS (
  SELECT y FROM (SELECT CAST({label} AS VARCHAR) AS y, count(*) AS c FROM {src}
                 WHERE split = 'train' AND {label} IS NOT NULL GROUP BY 1) ORDER BY c DESC, y ASC LIMIT 1
)""")
        recs.append(f"""SELECT '{t}' AS task, 'majority' AS model,
  round(avg(CAST(e.label = (SELECT y FROM {t}_maj) AS DOUBLE)), 4) AS accuracy, 1 AS n_params
  FROM ev_rows e WHERE e.task = '{t}' AND e.label IS NOT NULL""")
        for md in CANDIDATE_MIN_DF:
            p = f"{t}_d{md}"
            parts.append(S.nb_train(p, src, label, md).strip())
            parts.append(S.nb_apply(p, "sd", p).strip())
            recs.append(f"""SELECT '{t}', 'nb_df{md}',
  round(count(*) FILTER (WHERE e.label = r.{p}_label) / count(*), 4),
  (SELECT count(*) FROM {p}_kept) * (SELECT count(*) FROM {p}_prior) + (SELECT count(*) FROM {p}_prior)
  FROM ev_rows e JOIN {p}_res r ON r.doc_id = e.doc_id WHERE e.task = '{t}' AND e.label IS NOT NULL""")
    parts.append("recs AS (\n" + "\nUNION ALL\n".join(recs) + "\n)")
    return ",\n".join(parts)


@query("select_model", f"""WITH {_nb_candidates_sql()},
near AS (SELECT *, max(accuracy) OVER (PARTITION BY task) AS best FROM recs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY n_params ASC, model ASC) AS r
           FROM near WHERE accuracy >= best - 0.01)
SELECT task, model, accuracy, CAST(n_params AS BIGINT) AS n_params FROM ranked WHERE r = 1""")
def q_select_model(spark, sf_dir):
    from evenline.operators.selection import nb_candidates, select_model
    c = ctx(spark, sf_dir)
    parts = []
    for t in TASKS:
        train, test = c.task(t).where(F.col("split") == "train"), _task_test(c, t)
        maj = metrics.majority_baseline(train, test, "label")
        parts.append(maj.select(F.lit(t).alias("task"), F.lit("majority").alias("model"),
                                F.col("majority_accuracy").alias("accuracy"),
                                F.lit(1).cast("bigint").alias("n_params")))
    train, test = _all_tasks(c)
    recs = nb_candidates(train, test, "doc_id", TASK_LABELS, CANDIDATE_MIN_DF)
    for p in parts:
        recs = recs.unionByName(p)
    return select_model(recs, "accuracy", 0.01, "n_params").select("task", "model", "accuracy", "n_params")


TASK_LABELS = {"truth": "quality", "sentiment": "toxic", "bias": "lang"}


def _all_tasks(c: Context) -> tuple[DataFrame, DataFrame]:
    """Train and held-out documents with every task's label column (labels
    are one row per document, joined on)."""
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    d = c.docs.join(labels, "doc_id", "left")
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


STAGE_FRACTIONS = (0.1, 0.5, 1.0)  # shares of the 1K/5K/10K ladder


def _staged_fit_sql() -> str:
    parts = [S.docs_cte().strip(), S.LABELLED.strip(), S.test_rows()]
    recs = []
    for t, src, label in S.TASK_SOURCES:
        for f in STAGE_FRACTIONS:
            p = f"{t}_f{int(round(f * 1000))}"
            parts.append(f"{p}_src AS (SELECT * FROM {src} WHERE split = 'train' AND {S.uniform('text')} < {f})")
            parts.append(S.nb_train(p, f"{p}_src", label, 5).strip())
            parts.append(S.nb_apply(p, "sd", p).strip())
            recs.append(f"""SELECT '{t}' AS task, CAST({f} AS DOUBLE) AS stage,
  (SELECT count(*) FROM {p}_tr) AS n_train, count(*) AS n,
  round(count(*) FILTER (WHERE e.label = r.{p}_label) / count(*), 4) AS accuracy,
  round(avg(-ln(greatest(coalesce(py.p, 0.0), 1e-15))), 4) AS log_loss
  FROM ev_rows e JOIN {p}_res r ON r.doc_id = e.doc_id
  LEFT JOIN {p}_py py ON py.doc_id = e.doc_id AND py.y = e.label
  WHERE e.task = '{t}' AND e.label IS NOT NULL""")
    return "WITH " + ",\n".join(parts) + "\n" + "\nUNION ALL\n".join(recs)


@query("staged_fit", _staged_fit_sql())
def q_staged_fit(spark, sf_dir):
    from evenline.operators.selection import staged_fit_tasks
    train, test = _all_tasks(ctx(spark, sf_dir))
    return staged_fit_tasks(train, test, "doc_id", TASK_LABELS, STAGE_FRACTIONS, 5)


def compare_candidates(c: Context, task: str) -> list[tuple]:
    """A11 candidates of a task; every one fits inside its own call, so its
    seconds are fit and evaluation. Rows with ``terms`` (``Context.tokenised``)
    are not tokenised again; logistic regression reads ``text``."""
    from evenline.operators.mllib import fit_lr, lr_scores
    from evenline.operators.naive_bayes import fit_nb

    def run_nb(min_df):
        def run(tr, te):
            known = "terms" in tr.columns
            col = "terms" if known else "text"
            m = fit_nb(tr, task, col, min_df=min_df, tokenised=known)
            return metrics.accuracy(sc.score(te, m, "example_id", col, carry=["label"], tokenised=known), "label", f"{task}_label"), m.n_params
        return run

    def run_lr(tr, te):
        m = fit_lr(tr, f"{task}_lr")
        s = lr_scores(te, m, "text", keep=("example_id", "label"))
        return metrics.accuracy(s, "label", f"{task}_lr_label"), m.n_params

    def run_major(tr, te):
        return metrics.majority_baseline(tr, te, "label"), 1
    return [("majority", run_major), *[(f"nb_df{d}", run_nb(d)) for d in CANDIDATE_MIN_DF], ("lr_l1", run_lr)]


@query("model_compare", f"""WITH {_nb_candidates_sql()},
sizes AS (
  SELECT 'truth' AS task, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test' AND quality IS NOT NULL) AS n_test FROM lab
  UNION ALL SELECT 'sentiment', count(*) FILTER (WHERE split = 'train'), count(*) FILTER (WHERE split = 'test' AND toxic IS NOT NULL) FROM lab
  UNION ALL SELECT 'bias', count(*) FILTER (WHERE split = 'train'), count(*) FILTER (WHERE split = 'test' AND lang IS NOT NULL) FROM sd
)
SELECT r.task, r.model, n_train, n_test, accuracy, CAST(n_params AS BIGINT) AS n_params FROM recs r JOIN sizes s ON s.task = r.task""")
def q_model_compare(spark, sf_dir):
    """The candidates whose records DuckDB can check, without the measured
    seconds. ``compare_candidates`` adds logistic regression (pytest checks it)."""
    from evenline.operators.selection import evaluate
    c = ctx(spark, sf_dir)
    out = None
    for t in TASKS:
        train, test = (c.tokenised(t).where(F.col("split") == s) for s in ("train", "test"))
        recs = evaluate(spark, t, train, test, "example_id", [x for x in compare_candidates(c, t) if x[0] != "lr_l1"])
        out = recs if out is None else out.unionByName(recs)
    return out.drop("fit_seconds")


# --- calibrated confidence -----------------------------------------------------

def _tempered(c: Context) -> DataFrame:
    """Held-out rows (validation and test of the three-way split) at every grid temperature, from one scoring pass."""
    from evenline.operators.calibration import tempered
    _, test = _all_tasks(c)
    test = holdout_split(test, "text", THREE_WAY)
    s = sc.analyse(test, c.model_set, "doc_id", "text", carry=["split", *sorted(set(TASK_LABELS.values()))])
    return tempered(s, [(t, lab, t, c.models[t].classes) for t, lab in TASK_LABELS.items()])


def _tempered_sql() -> str:
    from evenline.operators.calibration import TEMPERATURES
    return f"""WITH {S.nb_all()},
truths AS (
  SELECT 'truth' AS task, doc_id, CAST(quality AS VARCHAR) AS label, {S.split3('text')} AS split FROM lab
  UNION ALL SELECT 'sentiment', doc_id, CAST(toxic AS VARCHAR), {S.split3('text')} FROM lab
  UNION ALL SELECT 'bias', doc_id, lang, {S.split3('text')} FROM sd
),
lps AS ({' UNION ALL '.join(f"SELECT '{t}' AS task, doc_id, y, lp, mx FROM {t}_rk" for t in TASKS)}),
grid AS (SELECT unnest([{', '.join(str(t) for t in TEMPERATURES)}])::DOUBLE AS temperature),
ps AS (SELECT g.temperature, l.task, l.doc_id, l.y, lp = mx AS top, exp((lp - mx) / g.temperature) AS e,
              sum(exp((lp - mx) / g.temperature)) OVER (PARTITION BY g.temperature, l.task, l.doc_id) AS z FROM lps l, grid g),
ev AS (SELECT p.temperature, p.task, x.split, p.doc_id, coalesce(max(e / z) FILTER (WHERE p.y = x.label), 0.0) AS p, max(e / z) AS conf,
              coalesce(min(p.y) FILTER (WHERE top) = any_value(x.label), false) AS hit
       FROM ps p JOIN truths x ON x.task = p.task AND x.doc_id = p.doc_id
       WHERE x.label IS NOT NULL AND x.split IN ('validation', 'test') GROUP BY p.temperature, p.task, x.split, p.doc_id),
fit AS (SELECT task, temperature, row_number() OVER (PARTITION BY task ORDER BY avg(-ln(greatest(p, 1e-15))), temperature) AS r
        FROM ev WHERE split = 'validation' GROUP BY task, temperature),
chosen AS (SELECT task, temperature AS t FROM fit WHERE r = 1)"""


@query("calibration", f"""{_tempered_sql()}
SELECT ev.task, t AS temperature, count(*) FILTER (WHERE temperature = 1) AS n,
       round(avg(-ln(greatest(p, 1e-15))) FILTER (WHERE temperature = 1), 4) AS log_loss_before,
       round(avg(-ln(greatest(p, 1e-15))) FILTER (WHERE temperature = t), 4) AS log_loss_after,
       round(avg(CAST(conf >= 0.9999 AS DOUBLE)) FILTER (WHERE temperature = 1), 4) AS saturated_before,
       round(avg(CAST(conf >= 0.9999 AS DOUBLE)) FILTER (WHERE temperature = t), 4) AS saturated_after
FROM ev JOIN chosen ON chosen.task = ev.task WHERE split = 'test' GROUP BY ev.task, t""")
def q_calibration(spark, sf_dir):
    from evenline.operators.calibration import calibration_report, fit_temperature
    rows = _tempered(ctx(spark, sf_dir))
    return calibration_report(rows, fit_temperature(rows))


@query("reliability", f"""{_tempered_sql()}
SELECT ev.task, CAST(least(floor(round(conf, 9) * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(CAST(hit AS DOUBLE)), 4) AS accuracy, round(avg(conf), 4) AS confidence
FROM ev JOIN chosen ON chosen.task = ev.task AND chosen.t = ev.temperature WHERE split = 'test' GROUP BY 1, 2""")
def q_reliability(spark, sf_dir):
    from evenline.operators.calibration import fit_temperature, reliability
    rows = _tempered(ctx(spark, sf_dir))
    return reliability(rows, fit_temperature(rows))


# --- loader, labels, per-class metrics, sink, page bias ---------------------------

@query("load_corpus", "SELECT CAST(doc_id AS VARCHAR) AS example_id, text, lang AS label, CAST(NULL AS VARCHAR) AS split FROM documents")
def q_load_corpus(spark, sf_dir):
    from evenline.sources.corpus import load_corpus
    return load_corpus(spark, f"{sf_dir.rstrip('/')}/documents.parquet", {"doc_id": "example_id", "lang": "label"})


def _case_sql(col: str, names: dict[str, str]) -> str:
    return "CASE CAST(" + col + " AS VARCHAR) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


@query("map_labels", f"SELECT doc_id, {_case_sql('quality', DISPLAY['truth'])} AS truth, {_case_sql('toxic', DISPLAY['sentiment'])} AS sentiment FROM labels")
def q_map_labels(spark, sf_dir):
    from evenline.operators.filters import map_labels
    d = ctx(spark, sf_dir).table("labels")
    d = map_labels(map_labels(d, "quality", DISPLAY["truth"], "truth"), "toxic", DISPLAY["sentiment"], "sentiment")
    return d.select("doc_id", "truth", "sentiment")


@query("per_class", f"""{_EVAL_SQL},
cf AS (SELECT task, label, pred, count(*) AS n FROM ev WHERE label IS NOT NULL AND pred IS NOT NULL GROUP BY task, label, pred),
k AS (SELECT task, label AS cls FROM cf UNION SELECT task, pred FROM cf),
m AS (SELECT k.task, k.cls, CAST(coalesce((SELECT sum(n) FROM cf WHERE cf.task = k.task AND cf.label = k.cls AND cf.pred = k.cls), 0) AS BIGINT) AS tp,
             CAST(coalesce((SELECT sum(n) FROM cf WHERE cf.task = k.task AND cf.label = k.cls), 0) AS BIGINT) AS actual,
             CAST(coalesce((SELECT sum(n) FROM cf WHERE cf.task = k.task AND cf.pred = k.cls), 0) AS BIGINT) AS predicted FROM k)
SELECT task, cls, tp, actual, predicted, round(CASE WHEN predicted > 0 THEN tp / predicted END, 4) AS precision, round(CASE WHEN actual > 0 THEN tp / actual END, 4) AS recall,
       round(CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted) END, 4) AS f1 FROM m""")
def q_per_class(spark, sf_dir):
    conf = metrics.confusion(evaluation_rows(spark, sf_dir), "label", "pred", by=["task"])
    return metrics.per_class(conf, ["task"])


def _task_rows(c: Context) -> DataFrame:
    parts = [c.task(t).select(F.lit(t).alias("task"), "label", "split") for t in TASKS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("majority", f"""WITH {S.docs_cte().strip()}, {S.LABELLED.strip()},
r AS (SELECT 'truth' AS task, CAST(quality AS VARCHAR) AS label, split FROM lab
      UNION ALL SELECT 'sentiment', CAST(toxic AS VARCHAR), split FROM lab UNION ALL SELECT 'bias', lang, split FROM sd),
c AS (SELECT task, label, row_number() OVER (PARTITION BY task ORDER BY count(*) DESC, label) AS k FROM r WHERE split = 'train' AND label IS NOT NULL GROUP BY task, label)
SELECT r.task, round(avg(CAST(r.label = c.label AS DOUBLE)), 4) AS majority_accuracy
FROM r LEFT JOIN c ON c.task = r.task AND c.k = 1 WHERE r.split = 'test' AND r.label IS NOT NULL GROUP BY r.task""")
def q_majority(spark, sf_dir):
    d = _task_rows(ctx(spark, sf_dir))
    return metrics.majority_baseline(d.where("split = 'train'"), d.where("split = 'test'"), "label", by=["task"])


@query("sink_round_trip", f"""WITH {S.nb_all()}
SELECT sd.doc_id, sd.lang, {', '.join(f"{t}_res.{t}_label AS {t}_label" for t in TASKS)} FROM sd {_ALL_RES}""")
def q_sink_round_trip(spark, sf_dir):
    """Results written in language partitions and read back."""
    from evenline.session import scratch_path
    from evenline.sources.sink import write_results
    c = ctx(spark, sf_dir)
    cols = ["doc_id", "lang", *[f"{t}_label" for t in TASKS]]
    rows = sc.analyse(c.docs, c.model_set, "doc_id", "text", carry=["lang"]).select(*cols)
    out = scratch_path(spark, "results")
    write_results(rows, out, ("lang",))
    return spark.read.schema(rows.schema).parquet(out).select(*cols)


_PAGE_TEXT_SQL = f"""pages_text AS (
  SELECT page_id AS doc_id, regexp_extract(html, '<html[^>]*lang="([a-z]+)', 1) AS label,
         nullif(concat_ws(' ', nullif(trim(title), ''), nullif(trim(heading), ''), nullif(trim(body), '')), '') AS text
  FROM (SELECT page_id, html,
               {S.clean("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
               {S.clean("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
               {S.clean("array_to_string(regexp_extract_all(html, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1), ' ')")} AS body
        FROM pages)),
pg AS (SELECT doc_id, label, text, {S.split2('text')} AS split, (text IS NULL OR trim(text) = '') AS blank FROM pages_text),
pg_tok AS (SELECT doc_id, unnest({S.dtoks('text')}) AS term FROM pg WHERE NOT blank)"""


@query("page_bias", f"""WITH {_PAGE_TEXT_SQL}, {S.nb('pb', "(SELECT * FROM pg WHERE label <> '')", 'label', 'pg')}
SELECT pg.doc_id AS page_id, pb_res.pb_label AS bias_label, round(pb_res.pb_conf, 4) AS bias_conf FROM pg LEFT JOIN pb_res ON pb_res.doc_id = pg.doc_id""")
def q_page_bias(spark, sf_dir):
    """A10 on title + heading + body; the page's declared language stands in for the outlet's leaning."""
    from evenline.operators.naive_bayes import fit_nb
    from evenline.plans.context import TWO_WAY
    from evenline.sources.pages import page_text
    pages = ctx(spark, sf_dir).table("pages").select("page_id", "html")
    label = F.nullif(F.regexp_extract("html", '<html[^>]*lang="([a-z]+)', 1), F.lit(""))
    d = holdout_split(page_text(pages).withColumn("label", label), "text", TWO_WAY)
    m = fit_nb(d.where("split = 'train'"), "bias")
    return sc.score(d, m, "page_id", "text").select("page_id", "bias_label", F.round("bias_conf", 4).alias("bias_conf"))


# --- cross-validation, paired choice, thresholds ---------------------------------------

@query("cross_validated", f"WITH {S.folds()} SELECT task, model, n, correct, accuracy, n_params FROM cv_rec")
def q_cross_validated(spark, sf_dir):
    from evenline.operators.validation import cross_validated
    return cross_validated(*ctx(spark, sf_dir).fold_predictions)


@query("mcnemar", f"WITH {S.folds()} SELECT task, model_a, model_b, a_only, b_only, round(stat, 4) AS statistic, stat > 3.841459 AS significant FROM cv_test")
def q_mcnemar(spark, sf_dir):
    from evenline.operators.validation import mcnemar
    return mcnemar(ctx(spark, sf_dir).fold_predictions[0])


@query("paired_choice", f"WITH {S.folds()} SELECT task, model, accuracy, n_params FROM cv_choice")
def q_paired_choice(spark, sf_dir):
    from evenline.operators.validation import cross_validated, mcnemar, paired_choice
    rows, params = ctx(spark, sf_dir).fold_predictions
    return paired_choice(cross_validated(rows, params), mcnemar(rows))


_CHOSEN_MODELS = ",\n".join(f"{S.nb_train(f'ch_{t}_{m}', src, label, m).strip()},\n{S.nb_apply(f'ch_{t}_{m}', 'sd', f'ch_{t}_{m}').strip()}" for t, src, label in S.TASK_SOURCES for m in (5, 3))


@query("chosen_scores", f"""WITH {S.folds()},
{_CHOSEN_MODELS}
SELECT sd.doc_id, {', '.join(f"CASE WHEN (SELECT model FROM cv_choice WHERE task = '{t}') = 'nb_df3' THEN ch_{t}_3_res.ch_{t}_3_label ELSE ch_{t}_5_res.ch_{t}_5_label END AS {t}_label" for t in TASKS)}
FROM sd {' '.join(f"LEFT JOIN ch_{t}_{m}_res ON ch_{t}_{m}_res.doc_id = sd.doc_id" for t in TASKS for m in (5, 3))}""")
def q_chosen_scores(spark, sf_dir):
    """A12 put to use: every document by the models that cross-validation chose, scored in the row."""
    from evenline.operators.inline import score_rows
    c = ctx(spark, sf_dir)
    return score_rows(c.doc_terms, {"": "terms"}, c.chosen_models, row="row").select("doc_id", *[f"{t}_label" for t in TASKS])


_HIST_SQL = f"""{S.nb_all()},
hist AS (SELECT task, split, CAST(greatest(-400, least(400, floor(round(s, 9) / 0.25))) AS INTEGER) AS bin, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg
  FROM (SELECT 'truth' AS task, {S.split3('lab.text')} AS split, quality = 1 AS y, truth_s AS s FROM lab JOIN truth_res r ON r.doc_id = lab.doc_id WHERE quality IS NOT NULL
        UNION ALL SELECT 'sentiment', {S.split3('lab.text')}, toxic = 1, sentiment_s FROM lab JOIN sentiment_res r ON r.doc_id = lab.doc_id WHERE toxic IS NOT NULL)
  WHERE split IN ('validation', 'test') GROUP BY 1, 2, 3),
roc AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, sum(pos) OVER (PARTITION BY task, split) AS n_pos, sum(neg) OVER (PARTITION BY task, split) AS n_neg
        FROM hist WINDOW d AS (PARTITION BY task, split ORDER BY bin DESC ROWS UNBOUNDED PRECEDING))"""


def _histogram(c: Context) -> DataFrame:
    from evenline.operators.inline import score_rows
    from evenline.operators.validation import score_histogram
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    held = holdout_split(documents(c.spark, c.sf_dir), "text", THREE_WAY).where("split in ('validation', 'test')")
    scored = score_rows(held, {"": "text"}, c.model_set).select("doc_id", "split", "truth_s", "sentiment_s").join(labels, "doc_id")
    return score_histogram(scored, [("truth", "quality", "1", "truth_s"), ("sentiment", "toxic", "1", "sentiment_s")])


@query("threshold_curve", f"WITH {_HIST_SQL} SELECT task, split, bin, tp::BIGINT AS tp, fp::BIGINT AS fp, n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg FROM roc")
def q_threshold_curve(spark, sf_dir):
    from evenline.operators.validation import roc_curve
    return roc_curve(_histogram(ctx(spark, sf_dir))).drop("pos", "neg")


@query("threshold_report", f"""WITH {_HIST_SQL},
cuts AS (SELECT task, bin, tp + n_neg - fp AS good FROM roc WHERE split = 'validation' UNION ALL SELECT task, max(bin) + 1, max(n_neg) FROM roc WHERE split = 'validation' GROUP BY task),
cut AS (SELECT task, bin AS cut FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY good DESC, bin DESC) AS r FROM cuts) WHERE r = 1),
major AS (SELECT task, sum(pos) > sum(neg) AS major FROM hist WHERE split = 'validation' GROUP BY task)
SELECT h.task, cut * 0.25::DOUBLE AS threshold, round(sum(neg * (tp - pos / 2)) / (max(n_pos) * max(n_neg)), 4) AS auc, sum(pos + neg)::BIGINT AS n,
       round(sum(CASE WHEN bin >= cut THEN pos ELSE neg END) / sum(pos + neg), 4) AS accuracy, round(sum(CASE WHEN major THEN pos ELSE neg END) / sum(pos + neg), 4) AS majority_accuracy,
       sum(CASE WHEN bin >= cut THEN pos ELSE neg END) >= sum(CASE WHEN major THEN pos ELSE neg END) AS reaches_majority
FROM roc h JOIN cut ON cut.task = h.task JOIN major ON major.task = h.task WHERE h.split = 'test' GROUP BY h.task, cut""")
def q_threshold_report(spark, sf_dir):
    from evenline.operators.validation import threshold_report
    return threshold_report(_histogram(ctx(spark, sf_dir)))


# --- isotonic calibration, used by the chart rows ------------------------------------------

_CAL_SCORES = {"truth": ("truth_res.truth_s", "quality = 1"), "sentiment": ("sentiment_res.sentiment_s", "toxic = 1"), "bias": ("bias_m.m", "bias_res.bias_label = lang")}
_BINS_SQL = f"""bias_m AS (SELECT doc_id, max(lp) FILTER (WHERE rk = 1) - max(lp) FILTER (WHERE rk = 2) AS m FROM bias_rk GROUP BY doc_id),
cal_in AS (SELECT 'truth' AS task, {S.split3('lab.text')} AS split, lab.doc_id, quality = 1 AS y, truth_s AS s FROM lab JOIN truth_res r ON r.doc_id = lab.doc_id WHERE quality IS NOT NULL
  UNION ALL SELECT 'sentiment', {S.split3('lab.text')}, lab.doc_id, toxic = 1, sentiment_s FROM lab JOIN sentiment_res r ON r.doc_id = lab.doc_id WHERE toxic IS NOT NULL
  UNION ALL SELECT 'bias', {S.split3('sd.text')}, sd.doc_id, sd.lang = r.bias_label, m FROM sd JOIN bias_res r ON r.doc_id = sd.doc_id JOIN bias_m b ON b.doc_id = sd.doc_id WHERE sd.lang IS NOT NULL),
cal_bin AS (SELECT *, CAST(greatest(-400, least(400, floor(round(s, 9) / 0.25))) AS INTEGER) AS bin FROM cal_in WHERE s IS NOT NULL),
cal_h AS (SELECT task, bin, count(*) FILTER (WHERE y) AS pos, count(*) AS n FROM cal_bin WHERE split = 'validation' GROUP BY task, bin),
cal_c AS (SELECT *, sum(pos) OVER w AS cp, sum(n) OVER w AS cn FROM cal_h WINDOW w AS (PARTITION BY task ORDER BY bin ROWS UNBOUNDED PRECEDING)),
cal_pair AS (SELECT i.task, i.bin, a.bin AS a, min((b.cp - a.cp + a.pos)::DOUBLE / (b.cn - a.cn + a.n)) AS m
  FROM cal_c i JOIN cal_c a ON a.task = i.task AND a.bin <= i.bin JOIN cal_c b ON b.task = i.task AND b.bin >= i.bin GROUP BY i.task, i.bin, a.bin),
cal_v AS (SELECT task, bin, round(max(m), 12) AS v FROM cal_pair GROUP BY task, bin),
cal_blk AS (SELECT v.task, v.v, min(v.bin) AS lo, (sum(h.pos) + 0.5) / (sum(h.n) + 1.0) AS p FROM cal_v v JOIN cal_h h ON h.task = v.task AND h.bin = v.bin GROUP BY v.task, v.v),
cal AS (SELECT task, lo, max(p) OVER (PARTITION BY task ORDER BY lo ROWS UNBOUNDED PRECEDING) AS p, lag(lo) OVER (PARTITION BY task ORDER BY lo) IS NULL AS first, lead(lo) OVER (PARTITION BY task ORDER BY lo) AS nxt FROM cal_blk)"""


def _cal_specs() -> list[tuple[str, str, str, str]]:
    return [("truth", "quality", "1", "truth_s"), ("sentiment", "toxic", "1", "sentiment_s"), ("bias", "bias_hit", "true", "bias_margin")]


def _held_scores(c: Context) -> DataFrame:
    """Validation and test rows with labels and the three scores that are calibrated: the logits of truth and sentiment,
    and how far bias' best class leads (its outcome: the class is right)."""
    from evenline.operators.calibration import margin
    from evenline.operators.inline import score_rows
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    held = holdout_split(documents(c.spark, c.sf_dir), "text", THREE_WAY).where("split in ('validation', 'test')")
    scored = score_rows(held, {"": "text"}, c.model_set)
    return scored.select("doc_id", "split", "truth_s", "sentiment_s", margin("bias_logp").alias("bias_margin"), (F.col("lang") == F.col("bias_label")).alias("bias_hit")).join(labels, "doc_id", "left")


def isotonic(c: Context) -> dict[str, list[float]]:
    from evenline.operators.calibration import fit_isotonic
    from evenline.operators.validation import score_histogram
    cached = getattr(c, "_isotonic", None)
    if cached is None:
        cached = c._isotonic = fit_isotonic(score_histogram(_held_scores(c), _cal_specs()))
    return cached


@query("isotonic_report", f"""WITH {S.nb_all()}, {_BINS_SQL},
ev AS (SELECT x.task, x.y, x.s, c.p FROM cal_bin x JOIN cal c ON c.task = x.task AND (x.bin >= c.lo OR c.first) AND (c.nxt IS NULL OR x.bin < c.nxt) WHERE x.split = 'test')
SELECT task, count(*) AS n, round(avg(-ln(greatest(1e-15, CASE WHEN y THEN 1 / (1 + exp(-s)) ELSE 1 / (1 + exp(s)) END))), 4) AS log_loss_raw,
       round(avg(-ln(CASE WHEN y THEN p ELSE 1 - p END)), 4) AS log_loss_isotonic FROM ev GROUP BY task""")
def q_isotonic_report(spark, sf_dir):
    from evenline.operators.calibration import calibrated
    from evenline.operators.validation import BIN
    c = ctx(spark, sf_dir)
    maps = isotonic(c)
    test = _held_scores(c).where("split = 'test'")
    items = [F.when(F.col(lab).isNotNull() & F.col(s).isNotNull(), F.struct(F.lit(t).alias("task"), (F.col(lab).cast("string") == F.lit(pos)).alias("y"), F.col(s).alias("s"),
             calibrated(F.col(s), maps[t], BIN).alias("p"))) for t, lab, pos, s in _cal_specs() if t in maps]
    rows = test.select(F.explode(F.array(*items)).alias("e")).where("e is not null").select("e.*")
    raw = F.when(F.col("y"), 1 / (1 + F.exp(-F.col("s")))).otherwise(1 / (1 + F.exp(F.col("s"))))
    return rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(-F.log(F.greatest(F.lit(1e-15), raw))), 4).alias("log_loss_raw"),
                                    F.round(F.avg(-F.log(F.when(F.col("y"), F.col("p")).otherwise(1 - F.col("p")))), 4).alias("log_loss_isotonic"))


_CAL_AXES = {"truth_probability": ("truth", "truth_res", "truth_s"), "emotional_intensity": ("sentiment", "sentiment_res", "sentiment_s"), "bias_degree": ("bias", "bias_mm", "bias_m")}


def _calibrated_radar_sql() -> str:
    parts = []
    for p, pre in (("before", ""), ("after", "after_")):
        for ax, (t, table, s) in _CAL_AXES.items():
            parts.append(f"""SELECT rw.doc_id, '{p}' AS phase, '{ax}' AS axis, round(c.p, 4) AS value
FROM rw LEFT JOIN {pre}{table} r ON r.doc_id = rw.doc_id LEFT JOIN cal c ON c.task = '{t}' AND r.{pre}{s} IS NOT NULL
 AND (CAST(greatest(-400, least(400, floor(round(r.{pre}{s}, 9) / 0.25))) AS INTEGER) >= c.lo OR c.first)
 AND (c.nxt IS NULL OR CAST(greatest(-400, least(400, floor(round(r.{pre}{s}, 9) / 0.25))) AS INTEGER) < c.nxt)""")
    return f"""WITH {S.rescored()}, {_BINS_SQL},
bias_mm AS (SELECT doc_id, m AS bias_m FROM bias_m),
after_bias_mm AS (SELECT doc_id, max(lp) FILTER (WHERE rk = 1) - max(lp) FILTER (WHERE rk = 2) AS after_bias_m FROM after_bias_rk GROUP BY doc_id)
{' UNION ALL '.join(parts)}"""


@query("calibrated_radar", _calibrated_radar_sql())
def q_calibrated_radar(spark, sf_dir):
    """A29 on calibrated values: rewrite, both texts scored in the row, each axis read from its isotonic fit."""
    from evenline.operators.calibration import calibrated, margin
    from evenline.operators.inline import score_rows
    from evenline.operators.validation import BIN
    c = ctx(spark, sf_dir)
    maps = isotonic(c)
    r = score_rows(rewritten(spark, sf_dir).select("doc_id", "text", "neutral"), {"before": "text", "after": "neutral"}, c.model_set, reuse={"after": "before"})
    values = [calibrated(margin(f"{p}_bias_logp") if t == "bias" else F.col(f"{p}_{t}_s"), maps[t], BIN).alias(f"{p}_{ax}") for p in cmp.PHASES for ax, (t, _, _) in _CAL_AXES.items()]
    return cmp.radar_rows(r.select("doc_id", *values), "doc_id")


# --- exact splits, quantiles, intervals ---------------------------------------------------

EXACT_SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


@query("exact_split", """WITH n AS (SELECT lang, count(*) AS n, (SELECT count(*) FROM documents) AS total FROM documents GROUP BY lang),
sizes AS (SELECT floor(0.8 * total + 0.5)::BIGINT AS a, floor(0.8 * total + 0.5)::BIGINT + floor(0.1 * total + 0.5)::BIGINT AS b FROM n LIMIT 1),
cut AS (SELECT n.lang, n.n, n.total, c.k, c.size, n.n * c.size // n.total AS base, n.n * c.size % n.total AS rest FROM n, (SELECT 0 AS k, a AS size FROM sizes UNION ALL SELECT 1, b FROM sizes) c),
given AS (SELECT *, base + (row_number() OVER (PARTITION BY k ORDER BY rest DESC, lang) <= size - sum(base) OVER (PARTITION BY k))::INT AS upto FROM cut),
placed AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(text), md5(doc_id::VARCHAR)) AS r FROM documents)
SELECT p.doc_id, CASE WHEN p.r <= a.upto THEN 'train' WHEN p.r <= b.upto THEN 'validation' ELSE 'test' END AS split
FROM placed p JOIN given a ON a.lang = p.lang AND a.k = 0 JOIN given b ON b.lang = p.lang AND b.k = 1""")
def q_exact_split(spark, sf_dir):
    from evenline.operators.splits import exact_split
    return exact_split(documents(spark, sf_dir), EXACT_SHARES, "text", "doc_id", "lang").select("doc_id", "split")


@query("effect_quantiles", f"""{_COMPARED_SQL},
deltas AS ({' UNION ALL '.join(f"SELECT split, lang, '{ax}' AS axis, after_{ax} - before_{ax} AS d FROM cmp" for ax in cmp.AXES)}),
grouped AS (SELECT split, lang, axis, list_sort(list(d) FILTER (WHERE d IS NOT NULL)) AS d FROM deltas GROUP BY axis, ROLLUP (split, lang))
SELECT split, lang, axis, coalesce(len(d), 0) AS n, {', '.join(f"round(d[greatest(1, ceil({q} * len(d) - 1e-9)::INT)], 4) + 0.0 AS p{round(100 * q)}" for q in (0.1, 0.5, 0.9))} FROM grouped""")
def q_effect_quantiles(spark, sf_dir):
    return cmp.effect_quantiles(compared(spark, sf_dir), ["split", "lang"])


@query("metric_intervals", f"""{_EVAL_SQL.replace("SELECT 'truth' AS task,", "SELECT sd.doc_id, 'truth' AS task,").replace("SELECT 'sentiment',", "SELECT sd.doc_id, 'sentiment',").replace("SELECT 'bias',", "SELECT sd.doc_id, 'bias',")},
w AS (SELECT task, doc_id, (label = pred)::INT AS v, b, ('0x'||substr(md5(doc_id::VARCHAR||':'||b::VARCHAR),1,8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM ev, (SELECT unnest(range(100)) AS b) WHERE label IS NOT NULL AND pred IS NOT NULL),
s AS (SELECT task, b, {' + '.join(f'(u >= {p})::INT' for p in metrics.POISSON)} AS w, v FROM w),
m AS (SELECT task, b, sum(w * v) / nullif(sum(w), 0) AS m, count(*) AS n, avg(v) AS e FROM s GROUP BY task, b),
a AS (SELECT task, max(n) AS n, max(e) AS e, list_sort(list(m) FILTER (WHERE m IS NOT NULL)) AS a FROM m GROUP BY task)
SELECT task, n, round(e, 4) AS estimate, round(a[greatest(1, ceil(len(a) * 0.025 - 1e-9)::INT)], 4) AS low, round(a[len(a) - greatest(1, ceil(len(a) * 0.025 - 1e-9)::INT) + 1], 4) AS high FROM a""")
def q_metric_intervals(spark, sf_dir):
    from evenline.operators.inline import score_rows
    c = ctx(spark, sf_dir)
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    test = score_rows(c.docs.where(F.col("split") == "test"), {"": "text"}, c.model_set).select("doc_id", "lang", *[f"{t}_label" for t in TASKS]).join(labels, "doc_id", "left")
    pairs = F.array(*[F.struct(F.lit(t).alias("task"), (F.col(lab).cast("string") == F.col(f"{t}_label")).cast("int").alias("v")) for t, lab in TASK_LABELS.items()])
    return metrics.metric_intervals(test.select("doc_id", F.explode(pairs).alias("e")).select("doc_id", "e.*"), "doc_id", "v", ["task"])


# --- scoring in the row: a map from the scan to the sink ------------------------------

_H_RES = " ".join(f"LEFT JOIN h_{t}_res ON h_{t}_res.doc_id = sd.doc_id" for t in TASKS)


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their hashed scores; every column of the documents stays in its row."""
    from evenline.operators.hashed import score_hashed
    c = ctx(spark, sf_dir)
    return score_hashed(c.docs, c.hashed_scorer)


@query("hashed_scores", f"""WITH {S.hashed_all()}
SELECT sd.doc_id, {', '.join(f"{t}_label, round({t}_conf, 4) AS {t}_conf" for t in TASKS)} FROM sd {_H_RES}""")
def q_hashed_scores(spark, sf_dir):
    return hashed(spark, sf_dir).select("doc_id", *[x for t in TASKS for x in (F.col(f"{t}_label"), F.round(f"{t}_conf", 4).alias(f"{t}_conf"))])


@query("hashed_accuracy", f"""WITH {S.hashed_all()},
ev AS (SELECT 'truth' AS task, CAST(l.quality AS VARCHAR) AS label, truth_label AS pred FROM sd JOIN labels l ON l.doc_id = sd.doc_id JOIN h_truth_res r ON r.doc_id = sd.doc_id WHERE sd.split = 'test'
       UNION ALL SELECT 'sentiment', CAST(l.toxic AS VARCHAR), sentiment_label FROM sd JOIN labels l ON l.doc_id = sd.doc_id JOIN h_sentiment_res r ON r.doc_id = sd.doc_id WHERE sd.split = 'test'
       UNION ALL SELECT 'bias', sd.lang, bias_label FROM sd JOIN h_bias_res r ON r.doc_id = sd.doc_id WHERE sd.split = 'test')
SELECT task, count(*) AS n, count(*) FILTER (WHERE label = pred) AS correct, round(count(*) FILTER (WHERE label = pred) / count(*), 4) AS accuracy
FROM ev WHERE label IS NOT NULL GROUP BY task""")
def q_hashed_accuracy(spark, sf_dir):
    c = ctx(spark, sf_dir)
    labels = c.table("labels").select("doc_id", "quality", "toxic")
    rows = hashed(spark, sf_dir).where(F.col("split") == "test").select("doc_id", "lang", *[f"{t}_label" for t in TASKS]).join(labels, "doc_id", "left")
    pairs = F.array(*[F.struct(F.lit(t).alias("task"), F.col(lab).cast("string").alias("label"), F.col(f"{t}_label").alias("pred")) for t, lab in TASK_LABELS.items()])
    return metrics.accuracy(rows.select(F.explode(pairs).alias("e")).select("e.*"), "label", "pred", by=["task"])


def _hashed_fmt_sql(t: str) -> str:
    return _fmt_sql(t, DISPLAY.get(t)).replace(f"{t}_res.", f"h_{t}_res.")


@query("hashed_prompt", f"""WITH {S.hashed_all()}
SELECT doc_id, CASE WHEN truth_fmt IS NULL OR sentiment_fmt IS NULL OR bias_fmt IS NULL OR text IS NULL THEN NULL
       ELSE printf('{rw.PROMPT_TEMPLATE}', truth_fmt, sentiment_fmt, bias_fmt, text) END AS prompt
FROM (SELECT sd.doc_id, sd.text, {', '.join(_hashed_fmt_sql(t) for t in TASKS)} FROM sd {_H_RES})""")
def q_hashed_prompt(spark, sf_dir):
    """A22 without moving the headline: scores, display text and prompt in one map."""
    f = sc.format_confidence(hashed(spark, sf_dir), TASKS, DISPLAY, NEAR)
    return rw.build_prompt(f, "text").select("doc_id", "prompt")


# --- M5: per language, stream, user profiles ----------------------------------

@query("multilingual", f"""WITH {S.LABELLED.strip()},
ml_tok AS (SELECT lang, toxic, unnest({S.dtoks('text')}) AS term FROM lab WHERE split = 'train' AND text IS NOT NULL),
ml_loaded AS (SELECT lang, term FROM ml_tok GROUP BY lang, term
              HAVING count(*) >= 8 AND count(*) FILTER (WHERE toxic = 1) * 10000 >= 9500 * count(*)),
ml_lex AS (SELECT lang, list(term) AS lex FROM ml_loaded GROUP BY lang),
r AS (SELECT d.doc_id, d.lang, d.text, {S.rewrite('d.text', 'coalesce(ml_lex.lex, []::VARCHAR[])')} AS neutral
      FROM documents d LEFT JOIN ml_lex ON ml_lex.lang = d.lang)
SELECT doc_id, lang, neutral, neutral IS DISTINCT FROM text AS changed FROM r""")
def q_multilingual(spark, sf_dir):
    from evenline.operators.lexicon import learn_loaded_terms
    c = ctx(spark, sf_dir)
    lex = learn_loaded_terms(c.task("sentiment").where(F.col("split") == "train"), by=["lang"])
    r = rw.neutral_rewrite(c.docs, lex, "text", "neutral", key="doc_id", by="lang")
    return r.select("doc_id", "lang", "neutral", (~F.col("neutral").eqNullSafe(F.col("text"))).alias("changed"))


def stream_process(c: Context):
    """The batch plan run on each micro-batch: split, rewrite, rescore."""
    from evenline.operators.inline import score_rows
    from evenline.operators.naive_bayes import ModelSet
    from evenline.plans.context import TWO_WAY
    lexicon = c.lexicon_terms if c.lexicon_terms is not None else c.loaded_terms
    models = ModelSet([c.models["sentiment"]])

    def process(batch: DataFrame) -> DataFrame:
        b = holdout_split(batch.select("doc_id", "text", "lang"), "text", TWO_WAY)
        r = (rw.neutral_rewrite(b, lexicon, "text", "neutral")
               .withColumn("changed", ~F.col("neutral").eqNullSafe(F.col("text"))))
        # scored in the row: neither text is a key of anything
        s = score_rows(r, {"before": "text", "after": "neutral"}, models, reuse={"after": "before"})
        return s.select("doc_id", "lang", "neutral", "changed", F.col("before_sentiment_label").alias("sentiment_before"),
                        F.col("after_sentiment_label").alias("sentiment_after"))
    return process


@query("stream_neutralize", f"""WITH {S.rescored()}
SELECT rw.doc_id, rw.lang, rw.neutral, rw.neutral IS DISTINCT FROM rw.text AS changed,
       sentiment_res.sentiment_label AS sentiment_before, after_sentiment_res.after_sentiment_label AS sentiment_after
FROM rw LEFT JOIN sentiment_res ON sentiment_res.doc_id = rw.doc_id
        LEFT JOIN after_sentiment_res ON after_sentiment_res.doc_id = rw.doc_id""")
def q_stream_neutralize(spark, sf_dir):
    from evenline.streaming.live import neutralize_stream, table_stream
    c = ctx(spark, sf_dir)
    schema = c.table("documents").schema
    stream = table_stream(spark, c.sf_dir, "documents", schema)
    out = neutralize_stream(spark, stream, stream_process(c), partition_by=["lang"])
    return out.select("doc_id", "lang", "neutral", "changed", "sentiment_before", "sentiment_after")


def doc_values(c: Context) -> DataFrame:
    """Per document axis values of the original text: one scoring pass,
    checkpointed once per dataset (one small row per document), then shared by
    the profile, history, personalised and stream queries instead of scoring
    the text again in every branch that needs it."""
    from evenline.operators.naive_bayes import class_probability
    cached = getattr(c, "_doc_values", None)
    if cached is not None:
        return cached
    a = sc.analyse(c.docs, c.model_set, "doc_id", "text")
    dv = a.where(F.col("truth_label").isNotNull()).select(
        "doc_id",
        class_probability("truth", c.models["truth"].classes, "1").alias("truth_probability"),
        class_probability("sentiment", c.models["sentiment"].classes, "1").alias("emotional_intensity"),
        F.col("bias_conf").alias("bias_degree"))
    c._doc_values = dv.checkpoint(eager=True)
    return c._doc_values


def reads(c: Context) -> DataFrame:
    from evenline.operators.profile import link_reads
    return link_reads(c.table("events").select("event_id", "ts", "user_id"), c.n_docs)


_DV_SQL = f"""{S.nb_all()},
dv AS (SELECT sd.doc_id, truth_res.truth_p1 AS truth_probability, sentiment_res.sentiment_p1 AS emotional_intensity,
              bias_res.bias_conf AS bias_degree FROM sd {_ALL_RES} WHERE NOT sd.blank),
reads AS (SELECT event_id, ts, user_id, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events)"""


@query("user_profile", f"""WITH {_DV_SQL}
SELECT user_id, count(*) AS n_reads,
       {', '.join(f'round(avg({v}), 4) AS {v}_mean' for v in cmp.AXES)}
FROM reads LEFT JOIN dv ON dv.doc_id = reads.doc_id GROUP BY user_id""")
def q_user_profile(spark, sf_dir):
    from evenline.operators.profile import user_bias_profile
    c = ctx(spark, sf_dir)
    return user_bias_profile(reads(c), doc_values(c), "user_id")


_HISTORY_SQL = f"""{_DV_SQL},
hist AS (
  SELECT event_id, user_id, reads.doc_id, count(*) OVER w AS prior_reads,
         {', '.join(f'round(avg({v}) OVER w, 4) AS prior_{v}_mean' for v in cmp.AXES)}
  FROM reads LEFT JOIN dv ON dv.doc_id = reads.doc_id
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""


@query("read_history", f"""WITH {_HISTORY_SQL}
SELECT event_id, user_id, doc_id, prior_reads, {', '.join(f'prior_{v}_mean' for v in cmp.AXES)} FROM hist""")
def q_read_history(spark, sf_dir):
    from evenline.operators.profile import prior_means
    c = ctx(spark, sf_dir)
    h = prior_means(reads(c), doc_values(c), "user_id", ("ts", "event_id"))
    return h.select("event_id", "user_id", "doc_id", "prior_reads", *[f"prior_{v}_mean" for v in cmp.AXES])


@query("profile_stream", f"""WITH {_HISTORY_SQL}
SELECT event_id, user_id, doc_id, prior_reads, {', '.join(f'prior_{v}_mean' for v in cmp.AXES)} FROM hist""")
def q_profile_stream(spark, sf_dir):
    """A33 live: the reads as a stream, running sums per user in the state store."""
    from evenline.operators.profile import link_reads
    from evenline.streaming.live import table_stream
    from evenline.streaming.profiles import profile_stream, run_stream
    c = ctx(spark, sf_dir)
    ev = table_stream(spark, c.sf_dir, "events", c.table("events").schema)
    rows, _ = run_stream(profile_stream(link_reads(ev.select("event_id", "ts", "user_id"), c.n_docs), doc_values(c)), spark)
    return rows.select("event_id", "user_id", "doc_id", "prior_reads", *[F.round(f"prior_{v}_mean", 4).alias(f"prior_{v}_mean") for v in cmp.AXES])


# A headline counts as published so many minutes after the start of the events (the test data has no such time).
PUBLISHED_START, PUBLISHED_STEP, READ_WITHIN = "2024-01-01", 10, "7 days"


@query("live_reads", f"""WITH {S.hashed_all()},
h AS (SELECT sd.doc_id, TIMESTAMP '{PUBLISHED_START}' + to_minutes(sd.doc_id * {PUBLISHED_STEP}) AS published, sentiment_label
      FROM sd LEFT JOIN h_sentiment_res r ON r.doc_id = sd.doc_id)
SELECT e.event_id, e.user_id, h.doc_id, CAST(floor(epoch(e.ts - h.published) / 60) AS BIGINT) AS minutes, h.sentiment_label
FROM events e JOIN h ON h.doc_id = e.event_id % (SELECT count(*) FROM documents) AND e.ts >= h.published AND e.ts <= h.published + INTERVAL {READ_WITHIN}""")
def q_live_reads(spark, sf_dir):
    """A32 and D4 on two streams: headlines are scored in the row as they arrive, and meet the reads of the next days."""
    from evenline.operators.hashed import score_hashed
    from evenline.operators.profile import link_reads
    from evenline.streaming.live import table_stream
    from evenline.streaming.profiles import live_reads, run_stream
    c = ctx(spark, sf_dir)
    docs = table_stream(spark, c.sf_dir, "documents", c.table("documents").schema).select("doc_id", "text")
    published = F.timestamp_add("MINUTE", F.col("doc_id") * PUBLISHED_STEP, F.lit(PUBLISHED_START).cast("timestamp"))
    heads = score_hashed(docs, c.hashed_scorer).select("doc_id", published.alias("published"), "sentiment_label")
    ev = table_stream(spark, c.sf_dir, "events", c.table("events").schema)
    rows, _ = run_stream(live_reads(heads, link_reads(ev.select("event_id", "ts", "user_id"), c.n_docs), within=READ_WITHIN), spark)
    minutes = F.floor((F.unix_micros("ts") - F.unix_micros("published")) / 60_000_000).cast("long")
    return rows.select("event_id", "user_id", "doc_id", minutes.alias("minutes"), "sentiment_label")


MILD_MIN_DF = 16  # the mild tier keeps only terms with twice the evidence
POLICY_THRESHOLD = 0.5


@query("personalised", f"""WITH {_HISTORY_SQL},
{S.LOADED.replace('lab AS', 'lab2 AS').replace('FROM lab ', 'FROM lab2 ').strip()},
mild AS (SELECT coalesce(list(term), []::VARCHAR[]) AS lex FROM loaded WHERE df >= {MILD_MIN_DF}),
tiered AS (
  SELECT d.doc_id, 'strong' AS tier, {S.rewrite('d.text', 'lex.lex')} AS neutral FROM documents d, lex
  UNION ALL
  SELECT d.doc_id, 'mild', {S.rewrite('d.text', 'mild.lex')} FROM documents d, mild
)
SELECT h.event_id, h.user_id, h.doc_id, t.tier, t.neutral
FROM hist h JOIN tiered t ON t.doc_id = h.doc_id
 AND t.tier = CASE WHEN h.prior_emotional_intensity_mean >= {POLICY_THRESHOLD} THEN 'strong' ELSE 'mild' END""")
def q_personalised(spark, sf_dir):
    from evenline.operators.profile import policy_tier, prior_means
    c = ctx(spark, sf_dir)
    h = prior_means(reads(c), doc_values(c), "user_id", ("ts", "event_id"))
    h = h.select("event_id", "user_id", "doc_id",
                 policy_tier("prior_emotional_intensity_mean", POLICY_THRESHOLD).alias("tier"))
    strong = c.loaded_terms
    mild = c.loaded_terms.where(F.col("df") >= MILD_MIN_DF)
    d = c.docs.select("doc_id", "text")
    tiered = (rw.neutral_rewrite(d, strong, "text", "strong", key="doc_id")
              .transform(lambda x: rw.neutral_rewrite(x, mild, "text", "mild", key="doc_id"))
              .select("doc_id", F.explode(F.array(
                  F.struct(F.lit("strong").alias("tier"), F.col("strong").alias("neutral")),
                  F.struct(F.lit("mild").alias("tier"), F.col("mild").alias("neutral")))).alias("t"))
              .select("doc_id", "t.tier", "t.neutral"))
    return h.join(tiered, ["doc_id", "tier"], "inner").select("event_id", "user_id", "doc_id", "tier", "neutral")


@query("stream_windows", f"""WITH {_DV_SQL}
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       round(avg(emotional_intensity), 4) AS emotional_intensity_mean
FROM reads LEFT JOIN dv ON dv.doc_id = reads.doc_id GROUP BY 1""")
def q_stream_windows(spark, sf_dir):
    from evenline.operators.profile import link_reads
    from evenline.streaming.live import run_complete, table_stream, windowed_scores
    c = ctx(spark, sf_dir)
    n_docs = c.n_docs
    ev = table_stream(spark, c.sf_dir, "events", c.table("events").schema)
    r = link_reads(ev.select("event_id", "ts", "user_id"), n_docs)
    agg = windowed_scores(r, doc_values(c).select("doc_id", "emotional_intensity"), "ts", "event_id",
                          "doc_id", "1 day", "1 hour", ("emotional_intensity",))
    return run_complete(agg, spark)


def _staged_rewriter_sql() -> str:
    parts = [S.docs_cte().strip(), S.LABELLED.strip(),
             "ho AS (SELECT sd.doc_id, sd.text, l.toxic FROM sd LEFT JOIN labels l ON l.doc_id = sd.doc_id "
             "WHERE sd.split = 'test')"]
    recs = []
    for f in STAGE_FRACTIONS:
        p = f"sr{int(round(f * 1000))}"
        parts.append(f"""{p}_tok AS (
  SELECT toxic, unnest({S.dtoks('text')}) AS term FROM lab
  WHERE split = 'train' AND text IS NOT NULL AND {S.uniform('text')} < {f}
),
{p}_loaded AS (SELECT term FROM {p}_tok GROUP BY term
               HAVING count(*) >= 8 AND count(*) FILTER (WHERE toxic = 1) * 10000 >= 9500 * count(*)),
{p}_lex AS (SELECT coalesce(list(term), []::VARCHAR[]) AS lex FROM {p}_loaded),
{p}_rw AS (SELECT ho.doc_id, ho.toxic, ho.text, {S.rewrite('ho.text', f'{p}_lex.lex')} AS neutral FROM ho, {p}_lex),
{p}_g AS (SELECT doc_id, toxic, neutral IS DISTINCT FROM text AS ch, {S.toks('text')} AS a, {S.toks('neutral')} AS b FROM {p}_rw),
{p}_ca AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(a) AS x FROM {p}_g) GROUP BY doc_id, x),
{p}_cb AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(b) AS x FROM {p}_g) GROUP BY doc_id, x),
{p}_ov AS (SELECT {p}_ca.doc_id, sum(least({p}_ca.c, {p}_cb.c)) AS o FROM {p}_ca JOIN {p}_cb
           ON {p}_ca.doc_id = {p}_cb.doc_id AND {p}_ca.x = {p}_cb.x GROUP BY {p}_ca.doc_id),
{p}_m AS (SELECT g.doc_id, g.toxic, g.ch,
                 round(CASE WHEN len(a) + len(b) > 0 THEN 2.0 * coalesce(ov.o, 0) / (len(a) + len(b)) END, 4) AS f1
          FROM {p}_g g LEFT JOIN {p}_ov ov ON ov.doc_id = g.doc_id)""")
        recs.append(f"""SELECT CAST({f} AS DOUBLE) AS stage, (SELECT count(*) FROM {p}_loaded) AS n_terms,
  count(*) AS n, count(*) FILTER (WHERE ch) AS n_changed, count(*) FILTER (WHERE toxic = 1) AS n_positive,
  count(*) FILTER (WHERE ch AND toxic = 1) AS n_positive_changed, round(avg(f1), 4) AS rouge1_f1_mean
  FROM {p}_m""")
    return "WITH " + ",\n".join(parts) + "\n" + "\nUNION ALL\n".join(recs)


@query("staged_rewriter", _staged_rewriter_sql())
def q_staged_rewriter(spark, sf_dir):
    """A13 for the rewriter: lexicon learned on nested train shares (sentiment
    proxy), every held-out document rewritten, quality per stage."""
    from evenline.operators.selection import staged_rewriter
    c = ctx(spark, sf_dir)
    labels = c.table("labels").select("doc_id", F.col("toxic").cast("string").alias("label"))
    train = c.task("sentiment").where(F.col("split") == "train")
    test = c.docs.where(F.col("split") == "test").join(labels, "doc_id", "left")
    return staged_rewriter(train, test, "doc_id", "label", "1", STAGE_FRACTIONS)


def _multilingual_scores_sql(langs=("de", "en", "es", "fr")) -> str:
    parts = [S.docs_cte().strip(), S.LABELLED.strip()]
    picks = []
    for lg in langs:
        t = f"ml_{lg}"
        parts.append(f"{t}_src AS (SELECT * FROM lab WHERE lang = '{lg}')")
        parts.append(S.nb_train(t, f"{t}_src", "toxic").strip())
        parts.append(S.nb_apply(t, "sd", t).strip())
        picks.append((lg, t))
    lab = "CASE " + " ".join(f"WHEN sd.lang = '{lg}' THEN {t}_res.{t}_label" for lg, t in picks) + " END"
    conf = "CASE " + " ".join(f"WHEN sd.lang = '{lg}' THEN {t}_res.{t}_conf" for lg, t in picks) + " END"
    joins = " ".join(f"LEFT JOIN {t}_res ON {t}_res.doc_id = sd.doc_id" for _, t in picks)
    return ("WITH " + ",\n".join(parts) +
            f"\nSELECT sd.doc_id, sd.lang, {lab} AS sentiment_label, round({conf}, 4) AS sentiment_conf FROM sd {joins}")


@query("multilingual_scores", _multilingual_scores_sql())
def q_multilingual_scores(spark, sf_dir):
    """A31 scoring: a sentiment model per language, weights keyed by (language,
    term); each document meets its own language's weights only."""
    from evenline.operators.naive_bayes import fit_nb_grouped, nb_scores_grouped
    c = ctx(spark, sf_dir)
    m = fit_nb_grouped(c.task("sentiment").where(F.col("split") == "train"), "lang")
    out = nb_scores_grouped(c.docs, "doc_id", "lang", m, "sentiment")
    return out.select("doc_id", "lang", "sentiment_label", F.round("sentiment_conf", 4).alias("sentiment_conf"))
