"""DataFrame operators: normalisation, quality rules, markets, seeding, dashboard series, factors."""
