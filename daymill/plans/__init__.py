"""Calendars, parameterised SQL, table definitions and whole jobs."""
