"""Training-data operators: dedup, mixing, archives, toxicity, decontamination, URL lists, PII.

Each module holds one operator with its own interface; ``queries.py`` registers the thin
``opN_<name>`` queries over it, ``oracles.py`` their DuckDB SQL.
"""
