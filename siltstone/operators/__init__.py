"""Part of the engine."""
