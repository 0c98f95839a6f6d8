"""Structured Streaming operators. None has a counterpart to match: they are extensions of the engine."""
