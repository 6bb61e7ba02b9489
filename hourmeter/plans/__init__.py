"""Plans: load, logs, views, the dashboard document, and the query contract."""
