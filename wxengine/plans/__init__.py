"""Models: staging, measurements, stations, and the jobs that keep them up to date."""
