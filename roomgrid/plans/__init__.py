"""The jobs: reports, analytics, rule checks, booking workflow."""
