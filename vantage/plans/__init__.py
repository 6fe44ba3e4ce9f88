"""Pipeline compositions and the catalogue of driver queries."""
