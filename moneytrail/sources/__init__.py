"""Raw layouts, file scans and sinks, the interest dictionary, and the test-table mapping."""
