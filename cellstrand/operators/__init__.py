"""Relational operators on reads, alignments, annotation and counts."""
