"""Operators on text corpora (training data preparation), each over whole tables.

Nothing else in the library imports this subpackage."""
