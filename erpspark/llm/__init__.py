"""Operators for preparing text corpora at scale; `catalog` registers one query per operator."""
