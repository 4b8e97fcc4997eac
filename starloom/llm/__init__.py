"""Operators for preparing language-model training data. Nothing outside this
folder (and the pipeline at the repository top) imports it."""
