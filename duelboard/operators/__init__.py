"""DataFrame operators: joins, groupings, fits and selections."""
