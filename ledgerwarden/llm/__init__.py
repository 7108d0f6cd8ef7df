"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries`` applies the operators to whole tables, ``oracle_sql`` states in
DuckDB SQL what SQL can express.
"""
