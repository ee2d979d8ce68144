"""DataFrame to DataFrame operators over the fact, dimension and record tables."""
