"""One registered query for each corpus operator, at its production parameters."""

from __future__ import annotations

from vitrine.llm import (block_lstm, count_bitmaps, fuzzy_lines, latent_leaks, license_index, minhash_forest, ngram_bayes, repair_ids,
                         robust_quality, suffix_dedup, sum_squares_packing, toxic_crf, walsh_codes)
from vitrine.llm import queries_sql as sql
from vitrine.llm.common import table
from vitrine.plans.registry import Registry

REG = Registry()


@REG.query("op2_minhash_forest")
def op2(spark, sf_dir):
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@REG.query("op1_robust_quality")
def op1(spark, sf_dir):
    return robust_quality.judge_documents(table(spark, sf_dir, "documents"))


@REG.query("op8_toxic_crf")
def op8(spark, sf_dir):
    return toxic_crf.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@REG.query("op5_suffix_dedup")
def op5(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@REG.query("op3_fuzzy_lines")
def op3(spark, sf_dir):
    return fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"))


@REG.query("op9_latent_leaks")
def op9(spark, sf_dir):
    return latent_leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@REG.query("op4_sum_squares_packing")
def op4(spark, sf_dir):
    return sum_squares_packing.pack_documents(table(spark, sf_dir, "documents"))


@REG.query("op10_repair_ids")
def op10(spark, sf_dir):
    return repair_ids.round_trip(table(spark, sf_dir, "documents"))


@REG.query("op6_block_lstm")
def op6(spark, sf_dir):
    return block_lstm.extract(table(spark, sf_dir, "pages"))


@REG.query("op7_license_index")
def op7(spark, sf_dir):
    return license_index.scan_licences(table(spark, sf_dir, "documents"))


@REG.query("op11_count_bitmaps", sql.DIVERGENCE)
def op11(spark, sf_dir):
    return count_bitmaps.divergence(table(spark, sf_dir, "documents"))


@REG.query("op12_walsh_codes", sql.CODES)
def op12(spark, sf_dir):
    return walsh_codes.encode(table(spark, sf_dir, "embeddings"))


@REG.query("op13_ngram_bayes")
def op13(spark, sf_dir):
    return ngram_bayes.predict(table(spark, sf_dir, "documents"))
