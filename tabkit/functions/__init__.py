"""Column expressions and the order / quantile primitives the operators share."""
