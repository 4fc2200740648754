"""Sources: driver-table scans, the flight-shaped projection, seeds, CSV landing."""
