"""The engine applied to the driver's tables, with the SQL that must give the same rows."""
