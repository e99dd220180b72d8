"""Writers of read files, alignments, tables and matrices."""
