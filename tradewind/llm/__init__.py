"""Operators for preparing training data, each over whole tables and whole texts."""
