"""The test tables dressed as the engine's sources, and queries over them."""
