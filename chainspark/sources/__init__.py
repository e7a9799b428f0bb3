"""Readers and writers of genome, alignment and chain files."""
