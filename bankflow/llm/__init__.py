"""Training-data operators: decontamination, token output, secret scans, WARC, quality rules, URL lists,
byte-level BPE, near-duplicates, toxicity and language identification.

Nothing outside this package imports it; ``registry`` lists its queries and their SQL.
"""
