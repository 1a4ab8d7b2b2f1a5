"""Writers of the engine's results."""
