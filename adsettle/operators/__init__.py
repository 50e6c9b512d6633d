"""DataFrame operators the settlement queries are made of."""
