"""Every operator as a query on the test tables, with its SQL statement."""
