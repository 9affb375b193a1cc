"""Relational operators of the medallion: dedup, expectations, consolidation, merge."""
