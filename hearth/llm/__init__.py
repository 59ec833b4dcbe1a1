"""Training-data operators: license scans, PII, toxicity, HTML extraction, embedding near-dedup,
exact dedup, piece sampling, n-gram Jaccard join, URL filters and source mixing.

Nothing outside this subpackage imports it. Each ``opN`` module holds one operator with its own
interface; ``queries.py`` registers the thin ``opN_<name>`` queries and ``oracle.py`` their SQL.
"""
