"""Column and join helpers shared by every operator."""
