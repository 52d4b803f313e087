"""Operators for training-data pipelines (language ID, URL rules, search, decontamination,
line and near-duplicate removal, PII, secrets, token output, BPE).

Nothing outside this subpackage imports it; ``queries.py`` holds the registered queries.
"""
