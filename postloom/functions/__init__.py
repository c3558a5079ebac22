"""Part of postloom."""
