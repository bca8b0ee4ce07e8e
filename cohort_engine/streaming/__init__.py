"""Scoring samples that arrive as a stream with a trained cohort pipeline."""
