"""The named jobs: staging, facts, marts, trip questions, activity reports, ingest and rides."""
