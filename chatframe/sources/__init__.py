"""Readers and writers: chat exports, JSON Lines, evaluation records, contacts, word lists, stage tables."""
