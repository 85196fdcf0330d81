"""Registered queries of the operators in this subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenline.llm.iblt import fingerprints
from evenline.llm.identifiers import KINDS, count_kind, find_personal_data, spell
from evenline.llm.language import fit_profiles, predict_language
from evenline.llm.likelihood import score_texts
from evenline.llm.mixing import mix_sources
from evenline.llm.repeats import remove_repeats
from evenline.llm.setjoin import jaccard_components
from evenline.llm.recount import count_with_edits
from evenline.llm.templates import find_contamination
from evenline.llm.toxicity import fit_toxicity, score_toxicity
from evenline.llm.turns import join_on, repair_conversations, repair_digests
from evenline.llm.variants import spelling_forms
from evenline.llm.wavelet import read_tokens, write_tokens
from evenline.session import scratch_path
from evenline.sources.corpus import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _remainder(modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def training_rows():
    """Rows that toxicity and language labels may be learned from."""
    return F.coalesce(_remainder(3) != 1, F.lit(True))


THRESHOLD = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    train = training_rows()
    model = fit_toxicity(docs.where(train), table(spark, sf_dir, "labels").select("doc_id", "toxic").where(train))
    return score_toxicity(docs, model).select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
                                              (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences", "worst")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def _edits(text: str = "text"):
    """Three edits of every text: a cut at a quarter, its head put in at the middle, its tail in capitals."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t).cast("long")
    quarter, middle = F.floor(n / 4), F.floor(n / 2)

    def edit(start, end, new):
        return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), new.alias("new"))
    cut = F.least(F.lit(40), F.floor(n / 8))
    return F.array(edit(quarter, quarter + cut, F.lit("")), edit(middle, middle, F.substring(t, 1, 30)),
                   edit(n - cut + F.least(F.lit(30), n) - F.least(F.lit(20), n), n, F.upper(F.substring(t, -20, 20))))


def op4_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_with_edits(_documents(spark, sf_dir), _edits(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = scratch_path(spark, "tokens")
    write_tokens(_documents(spark, sf_dir), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, out)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_documents(spark, sf_dir))


def op7_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = score_texts(docs, F.coalesce(_remainder(7) != 2, F.lit(True)), public_tokenizers.path("piece_bpe_32k.model"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = training_rows()
    found = predict_language(docs, fit_profiles(docs.where(train)))
    return found.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_documents(spark, sf_dir))
    return found.select("doc_id", *[count_kind("base", k).alias(f"n_{k}") for k in KINDS], F.sha2(spell(F.col("base")), 256).alias("base_sha256"),
                        spell(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after the faults that ``crc32("conv_id:turn") % 20`` puts in (nulls: one space)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("h"))
    h = F.col("h")
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(h == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return rows.where(h != 0).select("conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    counts, repaired = repair_conversations(damaged(conversations))
    names = [c for c in counts.columns if c != "conv_id"]
    out = join_on(join_on(conversations.select("conv_id").distinct(), counts, "conv_id", how="left"), repair_digests(repaired), "conv_id", how="left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(_documents(spark, sf_dir))


QUERIES = {"op1_toxicity": op1_toxicity,
           "op3_mixing": op3_mixing,
           "op2_decontamination": op2_decontamination,
           "op4_edit_aware_counts": op4_edit_aware_counts,
           "op5_token_output": op5_token_output,
           "op6_fingerprints": op6_fingerprints,
           "op7_lattice_likelihood": op7_lattice_likelihood,
           "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
           "op9_language_id": op9_language_id,
           "op10_substring_dedup": op10_substring_dedup,
           "op11_personal_data": op11_personal_data,
           "op12_conversation_repair": op12_conversation_repair,
           "op13_spelling_variants": op13_spelling_variants}
ORACLE: dict[str, str] = {}
