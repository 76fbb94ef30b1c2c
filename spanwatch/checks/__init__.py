"""Every operator run on the ``events`` table, with the same answer written in SQL."""
