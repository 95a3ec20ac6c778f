"""The operators applied to the input tables: each query reads whole tables."""
