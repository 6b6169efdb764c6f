"""The stages as incremental streams over arriving files."""
