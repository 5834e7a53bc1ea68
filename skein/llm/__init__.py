"""Operators for preparing language-model training data.

Each module holds one operator as DataFrame-in / DataFrame-out functions with column
names as parameters; ``queries`` applies them to the whole tables. Nothing outside this
subpackage imports it.
"""
