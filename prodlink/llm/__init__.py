"""Operators for large-scale training-data preparation (dedup, quality, packing, token output ...).

Nothing outside this subpackage imports it. Each module holds one operator and the
thin ``opN_<name>`` query over the ``documents`` (or ``conversations``) table;
``registry.py`` collects the queries and their DuckDB SQL.
"""
