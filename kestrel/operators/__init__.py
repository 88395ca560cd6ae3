"""Table-in / table-out operators: panel, quality, regression, timeseries,
tree, corpus, text, evaluate."""
