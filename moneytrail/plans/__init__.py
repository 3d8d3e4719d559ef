"""Session settings, size-checked joins, the landed store and user entry points."""
