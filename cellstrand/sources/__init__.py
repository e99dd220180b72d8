"""Readers of read files, alignments, annotation and lists."""
