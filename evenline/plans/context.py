"""Shared, lazily built inputs of the registered queries for one data folder:
the labelled proxy corpora with their splits, the learned lexicon and the
fitted models. Built once per (session, folder) and reused by every query."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.guards import MAX_INLINE_TERMS, bounded_collect
from evenline.operators.hashed import HashedScorer, fit_hashed
from evenline.operators.lexicon import learn_loaded_terms
from evenline.session import ensure_checkpoint_dir, written
from evenline.operators.naive_bayes import ModelSet, NBModel, fit_nb_variants
from evenline.functions.text import distinct_tokens, hash_bucket, is_blank
from evenline.operators.splits import holdout_split
from evenline.operators.validation import FOLDS, cross_validated, fold_predictions, mcnemar, paired_choice
from evenline.sources.corpus import PROXY_LABELS, documents, labelled_documents, table

TWO_WAY = (("train", 80), ("test", 20))
THREE_WAY = (("train", 80), ("validation", 10), ("test", 10))

_CACHE: dict[tuple[int, str, str], "Context"] = {}


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Context":
        k = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if k not in _CACHE:
            _CACHE[k] = cls(spark, sf_dir)
        return _CACHE[k]

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def docs(self) -> DataFrame:
        """``doc_id, text, lang`` with the two-way split on the text."""
        return holdout_split(documents(self.spark, self.sf_dir), "text", TWO_WAY)

    @property
    def labelled(self) -> DataFrame:
        """``doc_id, text, lang, quality, toxic, split`` (two-way, on the text)."""
        return holdout_split(labelled_documents(self.spark, self.sf_dir), "text", TWO_WAY)

    def task(self, task: str) -> DataFrame:
        """``example_id, text, label, lang, split`` for a task on the proxy labels."""
        table_name, col = PROXY_LABELS[task]
        src = self.docs if table_name == "documents" else self.labelled
        return src.select(F.col("doc_id").alias("example_id"), "text",
                          F.col(col).cast("string").alias("label"), "lang", "split")

    def tokenised(self, task: str) -> DataFrame:
        """:meth:`task` with the distinct ``terms`` (null for a blank text) in place of the text, found once and written
        for all tasks: fits and evaluations read them from there."""
        table_name, col = PROXY_LABELS[task]
        src = self._tokens if table_name == "documents" else self._labelled_tokens
        return src.select(F.col("doc_id").alias("example_id"), "terms", F.col(col).cast("string").alias("label"), "split")

    @cached_property
    def _tokens(self) -> DataFrame:
        terms = F.when(~is_blank("text"), distinct_tokens("text")).alias("terms")
        fold = F.pmod(hash_bucket("text"), F.lit(FOLDS)).alias("fold")
        return written(self.docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "lang", "split", fold, terms), "doc-terms")

    @property
    def doc_terms(self) -> DataFrame:
        """``row, doc_id, terms`` of every document: its distinct terms (null for a blank text) under its own row number."""
        return self._tokens.select("row", "doc_id", "terms")

    @cached_property
    def _train_terms(self) -> DataFrame:
        """The terms of the train rows with their fold and the labels of all tasks, written for the folds and for the fit."""
        labels = self.table("labels").select("doc_id", "quality", "toxic")
        train = self._tokens.where((F.col("split") == "train") & F.col("terms").isNotNull()).select("doc_id", "lang", "fold", "terms")
        return written(train.join(labels, "doc_id", "left").select(F.monotonically_increasing_id().alias("row"), "lang", "fold", "terms", "quality", "toxic"), "train-terms")

    @cached_property
    def _labelled_tokens(self) -> DataFrame:
        return written(self._tokens.join(self.table("labels").select("doc_id", "quality", "toxic"), "doc_id"), "labelled-terms")

    @cached_property
    def loaded_terms(self) -> DataFrame:
        """Lexicon learned on the train split of the sentiment proxy."""
        train = self.task("sentiment").where(F.col("split") == "train")
        ensure_checkpoint_dir(self.spark)
        return learn_loaded_terms(train, "text", "label", positive="1").checkpoint(eager=True)

    @cached_property
    def lexicon_terms(self) -> list[str] | None:
        """The loaded terms as a bounded driver-side list, or None when there
        are more than the inline limit (callers then take the join path)."""
        rows = bounded_collect(self.loaded_terms.select("term"), MAX_INLINE_TERMS)
        return None if rows is None else sorted(r.term for r in rows)

    @cached_property
    def n_docs(self) -> int:
        return self.table("documents").count()

    @cached_property
    def models(self) -> dict[str, NBModel]:
        """Naive Bayes per task, fitted on the train split (checkpointed counts)."""
        # one pass over the train documents for all three tasks: the labels
        # (one row per document) are joined on, each task counts its own rows
        labels = self.table("labels").select("doc_id", "quality", "toxic")
        train = self.docs.where(F.col("split") == "train").join(labels, "doc_id", "left")
        return fit_nb_variants(train, [("truth", None, 5, "quality"), ("sentiment", None, 5, "toxic"),
                                       ("bias", None, 5, "lang")], "text")

    @cached_property
    def model_set(self) -> ModelSet:
        """The three task models with their combined weights, in task order."""
        return ModelSet(self.models[t] for t in ("truth", "sentiment", "bias"))

    @cached_property
    def hashed_scorer(self) -> HashedScorer:
        """The three tasks over one set of slots, fitted on the train split."""
        labels = self.table("labels").select("doc_id", "quality", "toxic")
        train = self.docs.where(F.col("split") == "train").join(labels, "doc_id", "left")
        return fit_hashed(train, {"truth": "quality", "sentiment": "toxic", "bias": "lang"})

    @cached_property
    def fold_predictions(self) -> tuple[DataFrame, dict]:
        """Every candidate's cross-validated predictions on the train rows (written once), and their parameters."""
        rows, params = fold_predictions(self._train_terms, {"truth": "quality", "sentiment": "toxic", "bias": "lang"}, F.col("fold"), text="terms", row="row")
        return rows.checkpoint(eager=True), params

    @cached_property
    def chosen(self) -> dict[str, str]:
        """The candidate chosen per task by cross-validation and McNemar's test."""
        rows, params = self.fold_predictions
        return {r["task"]: r["model"] for r in paired_choice(cross_validated(rows, params), mcnemar(rows)).collect()}  # a row a task

    @cached_property
    def chosen_models(self) -> ModelSet:
        """The chosen naive Bayes models, fitted on all train rows; a task whose choice is the majority keeps min_df 5."""
        cols = {"truth": "quality", "sentiment": "toxic", "bias": "lang"}
        min_df = {t: int(m.removeprefix("nb_df")) if m.startswith("nb_df") else 5 for t, m in self.chosen.items()}
        fitted = fit_nb_variants(self._train_terms, [(t, None, min_df[t], c) for t, c in cols.items()], "terms", tokenised=True)
        return ModelSet(fitted[t] for t in cols)


# Display names of the proxy labels (A4). Bias stays as its proxy code.
DISPLAY = {"truth": {"0": "False", "1": "Truthful"}, "sentiment": {"0": "Neutral", "1": "Negative"}}
