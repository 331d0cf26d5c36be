"""Writers. Each may be run again and leaves the same result."""
