"""Column expressions: classifiers, latency arithmetic, price rules, date windows."""
