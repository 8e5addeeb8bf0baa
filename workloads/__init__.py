"""The library applied to the driver tables: adapters, queries, oracle SQL."""
