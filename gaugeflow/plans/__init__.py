"""Whole jobs, and the queries that check every operator."""
