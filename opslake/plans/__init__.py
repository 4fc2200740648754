"""Plans: the flight-domain builders (silver, gold, reports, gate, pipeline)."""
