"""Reading, checking and persisting tables."""
