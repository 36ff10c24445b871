"""Trusted models by declaration, and the refined models."""
