"""Running the incremental steps on arriving files."""
