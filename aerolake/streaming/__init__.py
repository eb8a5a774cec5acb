"""Structured Streaming jobs: landing -> bronze -> clean -> keyed facts."""
