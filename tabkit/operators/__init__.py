"""DataFrame-in, DataFrame-out operators and fit/apply pairs."""
