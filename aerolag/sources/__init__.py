"""Readers for the wide flights-with-weather table."""
