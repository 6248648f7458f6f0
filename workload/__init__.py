"""The engine's operators run over the driver's tables, each with an independent SQL check."""
