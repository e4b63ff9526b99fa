"""Readers, writers and the shapes in which applicant data arrives."""
