"""Operators on text corpora for training data, their queries, and the SQL that checks them."""
