"""Views over the test tables, the registered queries with their SQL, and the explorer routes."""
