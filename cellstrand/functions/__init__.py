"""Column expressions on sequences and alignments."""
