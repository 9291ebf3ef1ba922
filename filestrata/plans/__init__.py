"""The jobs: landing, Bronze batch, canonical tables."""
