"""Sources (readers of landing files and raw tables) and sinks."""
