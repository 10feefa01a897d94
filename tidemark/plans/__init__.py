"""Plans: derived inputs from the driver's tables and the registered queries."""
