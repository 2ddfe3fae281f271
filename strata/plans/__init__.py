"""Layer jobs (bronze -> silver -> gold) as DataFrame functions, the daily and
hourly job drivers, and the registered query catalogue."""
