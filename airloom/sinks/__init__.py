"""Writers for raw landings, the curated table and the dimension."""
