"""validate of the engine."""
