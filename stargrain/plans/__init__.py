"""Subject areas (weather, sales, campus) and the catalogue of registered queries."""
