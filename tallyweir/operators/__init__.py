"""DataFrame-to-DataFrame operators: parsing, aggregation, points and runs."""
