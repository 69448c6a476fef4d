"""DataFrame -> DataFrame operators.  No clock, no random ids, no session of their own."""
