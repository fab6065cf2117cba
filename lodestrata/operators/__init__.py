"""DataFrame-in, DataFrame-out operators of the knowledge-graph engine."""
