"""Incident-shaped frames made from the test tables, and SQL that says what to expect."""
