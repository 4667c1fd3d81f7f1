"""Scoring of streams of texts."""
