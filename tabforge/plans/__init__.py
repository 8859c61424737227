"""Query plans: fixtures, the query registry and registered queries."""
