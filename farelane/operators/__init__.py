"""Building blocks: each takes and returns DataFrames and starts no write."""
