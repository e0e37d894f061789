"""Column-level helpers: columns in, columns out, built-ins only."""
