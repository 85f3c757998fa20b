"""DataFrame -> DataFrame operators; nothing here starts a job unless it says so."""
