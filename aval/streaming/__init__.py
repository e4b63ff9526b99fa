"""Scoring of applicant documents as they arrive."""
