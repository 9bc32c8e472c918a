"""Plans: the SQL report set and the end-to-end run."""
