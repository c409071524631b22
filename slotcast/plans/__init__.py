"""Whole jobs composed of the operators: ingest, the weekly run, publishing."""
