"""Workload plans: charts reports, taxi-trip jobs, and the test relations they run on."""
