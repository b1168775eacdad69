"""Readers and writers: text lines, word lists, dense and sparse points,
ratings and folds, coefficient tables and result sinks."""
