"""Readers, writers and the entry view over the bundled star schema."""
