"""Analytics (gold views), serving queries and the query registry."""
