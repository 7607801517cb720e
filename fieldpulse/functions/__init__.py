"""Column-level helpers: guarded comparisons, time handling, banding and text."""
