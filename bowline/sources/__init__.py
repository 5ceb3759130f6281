"""Readers (driver tables, count-matrix text files, vocabulary, labels) and sinks."""

from bowline.sources.corpus import (
    read_table, Corpus, TextCorpus, CellCorpus, ClassSet, corpus_from_table, term_counts,
)

__all__ = ["read_table", "Corpus", "TextCorpus", "CellCorpus", "ClassSet", "corpus_from_table", "term_counts"]
