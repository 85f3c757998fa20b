"""Column -> Column helpers; nothing here starts a job."""
