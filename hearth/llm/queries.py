"""The registered queries of the operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from .common import read_table
from .op1_licenses import license_digest
from .op2_pii import pii_digest
from .op3_toxicity import toxicity_scores
from .op4_html import extract_main_text
from .op5_embeddings import near_duplicates
from .op6_exact import exact_duplicates
from .op7_pieces import sample_encodings
from .op8_jaccard import jaccard_components
from .op9_urls import judge_urls
from .op10_mix import mix_sources
from .op11_topk import exact_top_k
from .op12_middle import middle_digest
from .op13_search import ranked_search


def op1_license_scan(spark, sf_dir):
    return license_digest(read_table(spark, sf_dir, "documents"))


def op2_pii(spark, sf_dir):
    return pii_digest(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_html_text(spark, sf_dir):
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op5_embedding_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op6_exact_dedup(spark, sf_dir):
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op7_piece_samples(spark, sf_dir):
    return sample_encodings(read_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_mix(spark, sf_dir):
    out = mix_sources(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op11_exact_topk(spark, sf_dir):
    return exact_top_k(read_table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark, sf_dir):
    return middle_digest(read_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_pii, op3_toxicity, op4_html_text, op5_embedding_dedup, op6_exact_dedup, op7_piece_samples, op8_jaccard_join, op9_url_filter, op10_mix, op11_exact_topk, op12_fill_in_middle,
                                  op13_ranked_search)}
