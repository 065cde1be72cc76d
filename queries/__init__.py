"""Every operator as a query over the driver tables, with the SQL that gives the expected rows."""
