"""Readers for raw, cleaned and aggregated inputs, and generated trades."""
