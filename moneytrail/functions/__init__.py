"""Column-level helpers: lenient typing, display formatting, fixed constants, distributed ranks."""
