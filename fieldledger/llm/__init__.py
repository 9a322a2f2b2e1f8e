"""Corpus preparation for language-model training: ten Spark operators and their queries."""
