"""Archive files: what they are named, listed as and hold."""
