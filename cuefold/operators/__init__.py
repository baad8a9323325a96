"""DataFrame to DataFrame operators. Every one takes explicit key columns and never relies on row order."""
