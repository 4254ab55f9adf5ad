"""DataFrame operators: standardise, keep latest, enrich, roll up, compare over time, rank, check."""
