"""Plans: the pipeline that wires operators together and persists shared stages."""
