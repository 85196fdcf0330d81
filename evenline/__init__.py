"""evenline: headline analysis and neutral rewriting as Spark jobs.

Public operators (DataFrame in, DataFrame out) by inventory id:

    A1  load_corpus              A14 accuracy            A25 rescore
    A2  english_only             A15 log_loss            A26 compare_before_after
    A3  concat_fields            A16 rouge_n             A27 removed_terms
    A4  map_labels               A17 rouge_l             A28 meaning_preserved
    A5  holdout_split            A18 score               A29 radar_rows
    A6  split_profile            A19 analyse             A30 effect_summary
    A7  staged_subsets           A20 label_confidence    A31 nb_scores_grouped
    A8  fit_nb, fit_lr           A21 format_confidence   A32 neutralize_stream
    A11 evaluate                 A22 build_prompt        A33 user_bias_profile, prior_means
    A12 select_model             A23 neutral_rewrite     A34 policy_tier
    A13 staged_fit               A24 learn_loaded_terms  D5  write_results
"""

from evenline.operators.compare import (compare_before_after, effect_summary, meaning_preserved,
                                        radar_rows, rescore)
from evenline.operators.filters import concat_fields, english_only, map_labels
from evenline.operators.lexicon import learn_loaded_terms
from evenline.operators.metrics import accuracy, confusion, log_loss, per_class, rouge_l, rouge_n
from evenline.operators.mllib import fit_lr, lr_scores
from evenline.operators.naive_bayes import fit_nb, fit_nb_variants, nb_scores
from evenline.operators.profile import policy_tier, prior_means, user_bias_profile
from evenline.operators.rewrite import build_prompt, neutral_rewrite, removed_summary, removed_terms
from evenline.operators.scoring import analyse, format_confidence, label_confidence, score
from evenline.operators.selection import evaluate, select_model, staged_fit, staged_rewriter
from evenline.operators.splits import holdout_split, split_profile, staged_fractions, staged_subsets
from evenline.sources.corpus import load_corpus
from evenline.sources.sink import write_results
from evenline.streaming.live import neutralize_stream, windowed_scores

__version__ = "0.1.0"

__all__ = [
    "accuracy", "analyse", "build_prompt", "compare_before_after", "concat_fields", "confusion",
    "effect_summary", "english_only", "evaluate", "fit_lr", "fit_nb", "fit_nb_variants",
    "format_confidence", "holdout_split", "label_confidence", "learn_loaded_terms", "load_corpus",
    "log_loss", "lr_scores", "map_labels", "meaning_preserved", "nb_scores", "neutral_rewrite",
    "neutralize_stream", "per_class", "policy_tier", "prior_means", "radar_rows", "removed_summary",
    "removed_terms", "rescore", "rouge_l", "rouge_n", "score", "select_model",
    "split_profile", "staged_fit", "staged_fractions", "staged_rewriter", "staged_subsets",
    "user_bias_profile", "windowed_scores", "write_results",
]
