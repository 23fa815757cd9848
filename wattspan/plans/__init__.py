"""Stage runners and the catalogue of registered queries."""
