"""Column-level helpers shared by every plan."""
