"""Plans: one (condition, year) table, the single-pass grid, the matrix, the job entry points."""
