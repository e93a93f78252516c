"""Inputs: files that keep arriving, and generated records."""
