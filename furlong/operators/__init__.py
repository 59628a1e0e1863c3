"""Relational and data-level ML operators: ``DataFrame -> DataFrame``."""
