"""Writers of tables, databases and views."""
