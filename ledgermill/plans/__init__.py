"""The jobs: bronze, rates, silver, star schema, customer features, segments, reports."""
