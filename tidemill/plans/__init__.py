"""Sessions, jobs and the registered queries."""
